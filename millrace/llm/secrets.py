"""Secret scans: three base patterns, and formats learned from what they find.

Labelled credentials, those of the base patterns, form a prefix tree for each
kind. States whose continuations are statistically compatible are merged, which
leaves a probabilistic automaton of the kind's format. What is ordinary is
learned from all words that are too short to be candidates, so bare secrets,
however many, have no part in it. Every candidate string of every text is scored
by the likelihood that a format gives it against that of ordinary strings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heappush, heappushpop

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, col

#: The kinds in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Labelled strings of a kind that the automata are learned from: those with the smallest hashes. Longer strings than LABEL_CHARS aren't learned from.
LABELS = 400
LABEL_CHARS = 128
#: Slices of a kind, by hash, that the smallest hashes are looked for in before they meet.
SLICES = 64
#: Log-likelihood over that of ordinary strings, for each character, from which on a candidate counts.
LEAST_SCORE = 0.7
_END = ""


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place, end, credential) of the base patterns, in order."""
    found = []
    if ":" in text or "=" in text:
        lower = text.lower()
        if any(k in lower for k in _KEYS):
            found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, spans: Sequence[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Strings of credential characters, 16 and more, that no base span touches."""
    spans, k = sorted((s, e) for s, _, e, _ in spans), 0
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if not any(s < end and start < e for s, e in spans[k:k + 8]):
            yield start, end, m[0]


def short_words(text: str, spans: Sequence[tuple[int, int, int, str]]) -> list[str]:
    """The runs of credential characters that are too short for candidates and that no base span touches."""
    if not spans:
        return [w for w in _RUN.findall(text) if len(w) < 16]
    ends = sorted((s, e) for s, _, e, _ in spans)
    found, k = [], 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        while k < len(ends) and ends[k][1] <= start:
            k += 1
        if end - start < 16 and not any(s < end and start < e for s, e in ends[k:k + 8]):
            found.append(m[0])
    return found


@dataclass
class _State:
    """Strings that come by, that end here, and that go on with each character."""

    seen: int = 0
    ended: int = 0
    next: dict[str, "_State"] = field(default_factory=dict)
    uses: dict[str, int] = field(default_factory=dict)


def prefix_tree(strings: Sequence[str]) -> _State:
    root = _State()
    for string in strings:
        state = root
        state.seen += 1
        for c in string:
            state.uses[c] = state.uses.get(c, 0) + 1
            state = state.next.setdefault(c, _State())
            state.seen += 1
        state.ended += 1
    return root


def _differ(a: int, of_a: int, b: int, of_b: int, spread: float) -> bool:
    """Whether two shares are further apart than chance allows (Hoeffding)."""
    return abs(a / of_a - b / of_b) > spread * (of_a ** -0.5 + of_b ** -0.5)


def _compatible(a: _State, b: _State, spread: float) -> bool:
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if a is b:
            continue
        if _differ(a.ended, a.seen, b.ended, b.seen, spread):
            return False
        for c in a.uses.keys() | b.uses.keys():
            if _differ(a.uses.get(c, 0), a.seen, b.uses.get(c, 0), b.seen, spread):
                return False
            if c in a.next and c in b.next:
                todo.append((a.next[c], b.next[c]))
    return True


def _fold(into: _State, tree: _State) -> None:
    """Add a subtree's counts to the states that its strings reach from ``into``."""
    todo = [(into, tree)]
    while todo:
        into, tree = todo.pop()
        into.seen += tree.seen
        into.ended += tree.ended
        for c, n in tree.uses.items():
            into.uses[c] = into.uses.get(c, 0) + n
            if c in into.next:
                todo.append((into.next[c], tree.next[c]))
            else:
                into.next[c] = tree.next[c]


#: States as {character: (next state, log chance)}; the empty character ends a string.
Automaton = list[dict[str, tuple[int, float]]]


def infer(strings: Sequence[str], alpha: float = 0.01) -> Automaton:
    """The probabilistic automaton of the strings, by merging compatible states of their prefix tree.

    Kept states are compared with the most used state that follows them; what
    is compatible with none is kept. No strings give one state that only ends.
    """
    root, spread = prefix_tree(strings), math.sqrt(math.log(2 / alpha) / 2)
    kept = [root]
    while True:
        places = {id(s): k for k, s in enumerate(kept)}
        open_ = [(-t.seen, k, c) for k, s in enumerate(kept) for c, t in s.next.items() if id(t) not in places]
        if not open_:
            break
        _, k, c = min(open_)
        tree = kept[k].next[c]
        for state in kept:
            if _compatible(state, tree, spread):
                kept[k].next[c] = state
                _fold(state, tree)
                break
        else:
            kept.append(tree)
    found = []
    for state in kept:
        total = state.seen + 1
        chances = {c: (places[id(t)], math.log(state.uses[c] / total)) for c, t in state.next.items()}
        chances[_END] = (0, math.log((state.ended + 0.5) / total))
        found.append(chances)
    return found


#: Log chance of a character that a state has never seen; the walk goes on from the start.
_NEVER = math.log(1e-3)


def likelihood(automaton: Automaton, string: str) -> float:
    """The log chance of a string."""
    state, total = automaton[0], 0.0
    for c in string:
        step = state.get(c)
        if step is None:
            total += _NEVER
            state = automaton[0]
        else:
            total += step[1]
            state = automaton[step[0]]
    return total + state[_END][1]


def background(counts: dict[str, int]) -> Automaton:
    """The automaton of ordinary strings, from the counts of pairs of characters in words; the first of a pair is a blank at a word's start.

    One state for each character that came last. A tenth of the chance goes to
    that character once more (rules of dashes), a tenth to any character; the
    rest is the share of the pair, and for rare ones that of the character.
    """
    single = dict.fromkeys(_CHARACTERS, 0.5)
    before = dict.fromkeys(" " + _CHARACTERS, 0)
    for pair, n in counts.items():
        single[pair[1]] += n
        before[pair[0]] += n
    total, found = sum(single.values()), []
    for last in " " + _CHARACTERS:
        chances = {}
        for k, c in enumerate(_CHARACTERS):
            share = (counts.get(last + c, 0) + 20 * single[c] / total) / (before[last] + 20)
            again = 0.1 * (c == last) if last != " " else 0.1 * single[c] / total
            chances[c] = (k + 1, math.log(0.8 * share + again + 0.1 / len(_CHARACTERS)))
        chances[_END] = (0, math.log(0.05))
        found.append(chances)
    return found


#: Log chance of a digit within a number, which is ordinary whatever the corpus holds.
_DIGIT = math.log(1 / 10)


@dataclass(frozen=True)
class Formats:
    """Automata of credentials by kind, and that of ordinary strings."""

    credentials: dict[str, Automaton]
    ordinary: Automaton

    def score(self, string: str) -> float:
        """The best format's log-likelihood over that of ordinary strings, for each character."""
        if not self.credentials:
            return float("-inf")
        best = max(likelihood(a, string) for a in self.credentials.values())
        plain = likelihood(self.ordinary, string)
        if string.isdigit():
            plain = max(plain, _DIGIT * len(string))
        return (best - plain) / len(string)


def labelled(df: DataFrame, text: str = "text", labels: int = LABELS) -> DataFrame:
    """(kind, value): for each kind the distinct credentials, ``labels`` of them with the
    smallest hashes. All texts are searched; each task hands on its own smallest ones only.
    """
    bound_batches(df.sparkSession)

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[str, list] = {}
        held: dict[str, set] = {}

        def offer(kind: str, value: str) -> None:
            heap, in_ = heaps.setdefault(kind, []), held.setdefault(kind, set())
            if len(value) > LABEL_CHARS or value in in_:
                return
            item = (-xxhash.xxh64_intdigest(value, 7), value)
            if len(heap) < labels:
                heappush(heap, item)
                in_.add(value)
            elif item > heap[0]:
                in_.add(value)
                in_.discard(heappushpop(heap, item)[1])

        for batch in batches:
            for body in batch[0].to_pylist():
                for _, k, _, value in base_spans(body or ""):
                    offer(KINDS[k], value)
        rows = [(kind, value, -h) for kind, heap in heaps.items() for h, value in heap]
        if rows:
            kinds, values, hashes = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values), pa.array([h >> 1 for h in hashes])], names=["kind", "value", "hash"])

    found = df.select(col(text).alias("body")).mapInArrow(smallest, "kind string, value string, hash long").distinct()
    # First within slices of a kind, so the task of a kind reads SLICES * labels rows at most, however many tasks there were.
    for group in (["kind", F.pmod("hash", F.lit(SLICES))], ["kind"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy("hash", "value"))
        found = found.withColumn("place", place).filter(F.col("place") <= labels).drop("place")
    return found.select("kind", "value")


def pair_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(pair, n): how often each two characters follow each other in the short words of all texts.

    Every word counts as it is, in small and in capital letters. There are as
    many rows as pairs of characters at most, from each task too.
    """
    bound_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            words: Counter[str] = Counter()
            for body in batch[0].to_pylist():
                if body:
                    words.update(short_words(body, base_spans(body)))
            for word, n in words.items():
                for form in (word, word.lower(), word.upper()):
                    for pair in zip(" " + form, form):
                        pairs[pair] += n
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([a + b for a, b in pairs]), pa.array(list(pairs.values()), pa.int64())], names=["pair", "n"])

    counted = df.select(col(text).alias("body")).mapInArrow(count, "pair string, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text: str = "text", labels: int = LABELS) -> Formats:
    """The formats of the credentials in all texts, and what is ordinary in them; at most
    ``labels`` strings of each kind and the counts of pairs reach the driver.
    """
    values: dict[str, list[str]] = {}
    for row in labelled(df, text, labels).orderBy("kind", "value").collect():
        values.setdefault(row["kind"], []).append(row["value"])
    credentials = {kind: infer(v) for kind, v in values.items() if len(v) >= 8}
    return Formats(credentials, background({r["pair"]: r["n"] for r in pair_counts(df, text).collect()}))


def spans_of(text: str | None, formats: Formats | None, least: float = LEAST_SCORE, scores: dict[str, bool] | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text's secrets, in code points, by start and then kind."""
    text = text or ""
    base = base_spans(text)
    found = [(s, k, e) for s, k, e, _ in base]
    if formats is not None and formats.credentials:
        known = {} if scores is None else scores
        if len(known) > 200_000:
            known.clear()
        for start, end, value in candidates(text, base):
            secret = known.get(value)
            if secret is None:
                secret = known[value] = formats.score(value) >= least
            if secret:
                found.append((start, 3, end))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def find_secrets(text: Column, formats: Formats | None, least: float = LEAST_SCORE) -> Column:
    """The secrets of whole texts: ``array<struct<kind, start, end>>``, empty for NULL and empty texts.

    Without ``formats`` the base patterns alone.
    """
    scores: dict[str, bool] = {}

    @F.arrow_udf("array<struct<kind string, start int, end int>>")
    def spans(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, formats, least, scores)] for t in texts.to_pylist()], kind)

    return spans(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with each secret replaced by its kind in brackets; spans that overlap become one."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for body, each in zip(texts.to_pylist(), found.to_pylist()):
            if not body or not each:
                out.append(body)
                continue
            parts, at, end = [], 0, 0
            for span in each:
                if span["start"] >= end:
                    parts += [body[at:span["start"]], f"[{span['kind']}]"]
                end = at = max(end, span["end"])
            out.append("".join(parts) + body[at:])
        return pa.array(out, pa.string())

    return clean(text, spans)
