import re

from cases import empty, odd, plan  # noqa: F401
from millrace.llm import quality
from millrace.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(i + k for i in places for k in range(3))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_base_columns_and_verdicts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = QUERIES["op6_weak_supervision"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] in labels and not r["base_failed"]:
            assert r["kept"] == bool(labels[r["doc_id"]])


def test_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert not re.search("Python|Pandas|Arrow", plan(quality.with_metrics(docs, columns=["doc_id"])))


def test_expectation_maximisation_learns_accuracies():
    # The first two rules are right on 900 good and 100 bad documents, the third is wrong half the time.
    patterns = [((1, 1, 1), 450), ((1, 1, -1), 450), ((-1, -1, 1), 50), ((-1, -1, -1), 50)]
    model = quality.fit(patterns)
    assert model.accuracies[0] > 0.95 and model.accuracies[1] > 0.95 and model.accuracies[2] == quality.LEAST
    assert quality.fit([]).accuracies == ()


def test_odd_rows(spark, odd, empty):
    got = quality.judge(odd).collect()
    assert len(got) == odd.count()
    by_text = {r["text"]: r for r in got}
    for text in (None, "", " \n\t "):
        assert by_text[text]["n_words"] == 0 and by_text[text]["base_failed"] is True and by_text[text]["kept"] is False
    assert all((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])[:5] for r in got)
    assert quality.judge(empty).count() == 0
