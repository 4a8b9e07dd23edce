import hashlib
import random
import re

import pytest
from cases import empty, odd  # noqa: F401
from millrace.llm import secrets
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    random.seed(4)
    bits = ["password", "PassWd", "TOKEN", "api_key", "ApiKey", "secret", "=", ":", " ", "\"", "'", "abcdefgh", "12345678", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef" * 2, "\n", "é", "ſecret", "toKen", "password=token: longer_value9"]
    for _ in range(5000):
        text = "".join(random.choice(bits) for _ in range(random.randint(1, 14)))
        assert [(s, k, e) for s, k, e, _ in secrets.base_spans(text)] == brute(text), text


def test_automata_tell_formats_from_words():
    random.seed(9)
    word = lambda: "".join(random.choice(["the", "ing", "tion", "re", "un", "ed", "ou"]) for _ in range(random.randint(6, 9)))
    key = lambda: "sk_" + "".join(random.choice("ABCDEFGH23456789") for _ in range(20))
    formats = secrets.Formats({"key": secrets.infer(sorted({key() for _ in range(300)}))}, secrets.infer(sorted({word() for _ in range(300)})))
    assert len(formats.credentials["key"]) < 60  # states are merged, not kept as a tree of 6000
    keys, words = [formats.score(key()) for _ in range(200)], [formats.score(word()) for _ in range(200)]
    assert sum(s >= secrets.LEAST_SCORE for s in keys) >= 190 and sum(s >= secrets.LEAST_SCORE for s in words) <= 4
    assert secrets.infer([]) and secrets.Formats({}, secrets.infer([])).score("x") == float("-inf")


def test_chances_of_a_state_add_up():
    import math

    for state in secrets.infer(["ab", "abab", "ba", "a", "ababab"] * 30):
        assert sum(math.exp(p) for _, p in state.values()) < 1.01


def test_query_keeps_the_base(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op9_format_automata"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = brute(texts[r["doc_id"]])
        line = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in base) for n in range(3)]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("format")] == [x for x in line.split(",") if x]


def test_odd_rows(spark, odd, empty):
    formats = secrets.learn(odd)
    rows = odd.withColumn("found", secrets.find_secrets(F.col("text"), formats)).withColumn("clean", secrets.redact(F.col("text"), F.col("found"))).collect()
    for r in rows:
        assert [(s["start"], secrets.KINDS.index(s["kind"]), s["end"]) for s in r["found"] if s["kind"] != "format"] == brute(r["text"])
        assert (r["clean"] == r["text"]) == (not r["found"])
    secret = next(r for r in rows if r["text"] and "AKIA" in r["text"])
    assert not brute(secret["clean"]) and "[assign]" in secret["clean"] and "[access] [hex] é" in secret["clean"]
    assert secrets.learn(empty).credentials == {} and empty.select(secrets.find_secrets(F.col("text"), None)).count() == 0


@pytest.mark.parametrize("bare,plain", [(8, 792), (400, 400), (720, 80)])
def test_bare_keys_are_found_whatever_their_share(spark, bare, plain):
    random.seed(bare)
    word = lambda: random.choice(["the", "ing", "tion", "re", "un", "ed", "ou", "mer", "sal", "vic"])
    key = lambda n: "".join(random.choice("0123456789abcdef") for _ in range(n))
    prose = lambda: " ".join(word() + word() for _ in range(30)) + f" {random.randrange(2030)} "
    keys = [key(24) for _ in range(bare)]
    words = ["".join(word() for _ in range(8)) for _ in range(plain // 2)] + [str(random.randrange(10 ** 15, 10 ** 16)) for _ in range(plain // 2)]
    texts = [prose() + x + " end" for x in keys + words] + [f"{prose()} token = {key(24)}" for _ in range(60)]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    formats = secrets.learn(frame)
    found = {r["doc_id"] for r in frame.withColumn("found", secrets.find_secrets(F.col("text"), formats)).filter("exists(found, x -> x.kind = 'format')").collect()}
    assert sum(n in found for n in range(bare)) >= 0.97 * bare
    assert not any(n >= bare for n in found)


def test_ordinary_strings_of_any_form_stay_below(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    formats = secrets.learn(docs)
    assert formats.credentials
    for string in ["-" * 20, "=" * 30, "0" * 16, "a" * 20, "4556756555320544", "INTERNATIONALIZATION", "internationalization", "some_long_snake_case_name", "SOME_CONSTANT_NAME_HERE", "2021-03-04-12-30-11"]:
        assert formats.score(string) < secrets.LEAST_SCORE, string
