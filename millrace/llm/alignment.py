"""Alignment of two tokenizers' tokens by lockstep merging.

A batch of documents is encoded by both tokenizers. One NumPy vector holds a
pair of pointers for every document, and all pairs move at once: the token
that ends first is passed, and where both end at the same byte the document is
cut. Documents that are done leave the vector. The tokens between two cuts are
a group, and all A and B tokens of a group are linked.

Links are counted over the corpus by the documents that hold them. Each batch
lists its distinct links once, with the number of its documents that hold
them; only these lists are shuffled, and their counts come back to the batch.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from millrace.llm.bpe import _BLANK, _BYTE_LEVEL, _SETTLED, byte_symbols
from millrace.llm.common import bound_batches, col, unused
from millrace.session import materialise

#: Chunks of text that a worker remembers, and their characters; both are forgotten when either is passed.
CACHE_CHUNKS, CACHE_CHARS = 250_000, 8_000_000
#: A group of up to so many links is written out link by link before they are counted; a larger one by its distinct ids.
_PLAIN_LINKS = 4096
#: Bytes of text that are merged in one lockstep.
_AT_ONCE = 4 << 20
#: Blanks and what follows them. No token of either tokenizer spans two of these: texts with a carriage return, which some do, are one chunk.
_chunks = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+").findall
_MADE = "n_a long, n_b long, n_groups long, n_links long, groups string"


class Encoders:
    """The ids of both tokenizers for whole texts, and the bytes of their tokens.

    A reads the text with a blank before it, B adds one itself, so a chunk is
    what both see between the same two bytes.
    """

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        back = {s: b for b, s in enumerate(byte_symbols())}
        vocab = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.library = Tokenizer.from_file(path_a)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.ranks = tiktoken.Encoding("a", pat_str=_BYTE_LEVEL, mergeable_ranks=vocab, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = token
        for token, i in special.items():
            self.bytes_a[i] = token.encode()
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.size_a, self.size_b = (np.array(list(map(len, b)), np.int64) for b in (self.bytes_a, self.bytes_b))
        # Pieces that have blanks after other characters: texts with these blanks are encoded whole.
        spanning = {c for n in names for c in re.findall(f"(?<=[^{_BLANK}▁])[{_BLANK}]", n)}
        self.whole = re.compile(f"[{re.escape(''.join(sorted(spanning)))}]") if spanning else None
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError(f"{path_b} has pieces of several words")
        #: Ids of "a", which stands before chunks that the blank B adds isn't the first character of.
        self.lead = len(self.pieces.encode("a"))
        #: Decimal ids as written into groups: A's followed by a comma or a bar, then B's by a comma or a semicolon.
        written = [f"{i}{end}".encode() for size, ends in ((len(self.bytes_a), ",|"), (len(names), ",;")) for i in range(size) for end in ends]
        self.written = np.empty(len(written), object)
        self.written[:] = written
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.fits = np.zeros(0, bool)

    def _learn(self, chunks: list[str]) -> None:
        """Add the chunks' ids, and whether both tokenizers' bytes are theirs."""
        plain = [bool(_SETTLED.fullmatch(c)) for c in chunks]
        odd = iter(self.library.encode_batch([c for c, p in zip(chunks, plain) if not p], add_special_tokens=False))
        a = [self.ranks.encode_ordinary(c) if p else next(odd).ids for c, p in zip(chunks, plain)]
        led = [c[0] != " " or c == " " for c in chunks]
        b = self.pieces.encode(["a" + c if x else c[1:] for c, x in zip(chunks, led)], num_threads=1)
        b = [ids[self.lead:] if x else ids for ids, x in zip(b, led)]
        whole = [c.encode() for c in chunks]
        fits = [b"".join(map(self.bytes_a.__getitem__, x)) == w == b"".join(map(self.bytes_b.__getitem__, y)) for w, x, y in zip(whole, a, b)]
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.chars += sum(map(len, chunks))
        for side, lists in enumerate((a, b)):
            flat = array("i")
            for ids in lists:
                flat.extend(ids)
            self.ids[side] = np.concatenate([self.ids[side], np.array(flat, np.int32)])
            self.ends[side] = np.concatenate([self.ends[side], self.ends[side][-1] + np.cumsum(list(map(len, lists)), dtype=np.int64)])
        self.fits = np.concatenate([self.fits, np.array(fits, bool)])

    def encode(self, texts: list[str | None]) -> tuple:
        """(ids of A, ends of texts in them, ids of B, ends of texts in them).

        A text that is NULL or empty, or for which the joined bytes of either
        tokenizer aren't the text with a blank before it, has no ids.
        """
        cut = []
        for text in texts:
            text = " " + text if text else ""
            cut.append([text] if self.whole and self.whole.search(text) else _chunks(text))
        new = set().union(*cut) - self.known.keys()
        if len(self.known) + len(new) > CACHE_CHUNKS or self.chars + sum(map(len, new)) > CACHE_CHARS:
            self.forget()
            new = set().union(*cut)
        if new:
            self._learn(list(new))
        get = self.known.__getitem__
        chunk = np.fromiter((i for chunks in cut for i in map(get, chunks)), np.int64)
        ends = np.cumsum([0, *map(len, cut)])
        bad = set(np.searchsorted(ends, np.flatnonzero(~self.fits[chunk]), "right") - 1) if not self.fits.all() else set()
        if bad:
            whole = {r: self._whole(texts[r], chunk[ends[r]:ends[r + 1]]) for r in bad}
            keep = np.ones(len(chunk), bool)
            for r in bad:
                keep[ends[r]:ends[r + 1]] = whole[r]
            row = np.repeat(np.arange(len(cut)), np.diff(ends))[keep]
            chunk, ends = chunk[keep], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(cut)))])
        out = []
        for ids, at in zip(self.ids, self.ends):
            sizes = at[chunk + 1] - at[chunk]
            after = np.cumsum(sizes)
            out += [ids[np.arange(after[-1] if len(after) else 0) + np.repeat(at[chunk] - (after - sizes), sizes)], np.concatenate([[0], after])[ends]]
        return tuple(out)

    def _whole(self, text: str, chunks: np.ndarray) -> bool:
        """Whether the bytes of all chunks together are the text's, though those of one aren't the chunk's."""
        for ids, at, names in zip(self.ids, self.ends, (self.bytes_a, self.bytes_b)):
            if b"".join(names[i] for c in chunks for i in ids[at[c]:at[c + 1]]) != b" " + text.encode():
                return False
        return True


@lru_cache(maxsize=2)
def encoders(path_a: str, path_b: str) -> Encoders:
    """The worker's encoders for two files; they live as long as the worker."""
    return Encoders(path_a, path_b)


def lockstep(ends_a: np.ndarray, rows_a: np.ndarray, ends_b: np.ndarray, rows_b: np.ndarray) -> np.ndarray:
    """The groups of all documents: rows (first A token, after the last, first B token, after the last), in order.

    ``ends_a`` and ``ends_b`` have the byte after each token within its
    document, ``rows_a`` and ``rows_b`` where each document's tokens begin, and
    the end of the last. The last tokens of a document end at the same byte.
    """
    live = np.flatnonzero(rows_a[1:] > rows_a[:-1])
    a, b, last = rows_a[live], rows_b[live], rows_a[live + 1]
    from_a, from_b = a.copy(), b.copy()
    found = [np.zeros((4, 0), np.int64)]
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        cut = np.flatnonzero(end_a == end_b)
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        if len(cut):
            found.append(np.stack([from_a[cut], a[cut], from_b[cut], b[cut]]))
            from_a[cut], from_b[cut] = a[cut], b[cut]
            left = a < last
            if not left.all():
                a, b, last, from_a, from_b = a[left], b[left], last[left], from_a[left], from_b[left]
    groups = np.concatenate(found, axis=1)
    return groups[:, np.argsort(groups[0])].T


def links(groups: np.ndarray, doc: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, width: int) -> tuple:
    """(document, pair, times): the distinct links of each document, a pair being ``a * width + b``."""
    sizes_a, sizes_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    n = sizes_a * sizes_b
    plain = n <= _PLAIN_LINKS
    g = np.repeat(np.flatnonzero(plain), n[plain])
    nth = np.arange(len(g)) - np.repeat(np.cumsum(n[plain]) - n[plain], n[plain])
    docs = [doc[g]]
    pairs = [ids_a[groups[g, 0] + nth // sizes_b[g]].astype(np.int64) * width + ids_b[groups[g, 2] + nth % sizes_b[g]]]
    times = [np.ones(len(g), np.int64)]
    for k in np.flatnonzero(~plain):
        one, many = np.unique(ids_a[groups[k, 0]:groups[k, 1]], return_counts=True)
        two, more = np.unique(ids_b[groups[k, 2]:groups[k, 3]], return_counts=True)
        pairs.append((one.astype(np.int64)[:, None] * width + two).ravel())
        times.append((many[:, None] * more).ravel())
        docs.append(np.full(len(pairs[-1]), doc[k]))
    docs, pairs, times = map(np.concatenate, (docs, pairs, times))
    order = np.lexsort((pairs, docs))
    docs, pairs, times = docs[order], pairs[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])])) if len(docs) else order
    return docs[first], pairs[first], np.add.reduceat(times, first) if len(first) else times


def _written(engine: Encoders, groups: np.ndarray, ids_a, rows_a, ids_b, rows_b) -> list[bytes]:
    """Each document's groups as text: A's ids, a bar, B's ids, groups parted by semicolons."""
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    for ids, begin, end, shift, base in ((ids_a, 0, 1, 2, 0), (ids_b, 2, 3, 1, 2 * len(engine.bytes_a))):
        closing = np.zeros(len(ids), np.int64)
        closing[groups[:, end] - 1] = 1
        # Before a token stand all earlier ones of its side, and those of the other side up to its group.
        place = np.arange(len(ids)) + np.repeat(groups[:, shift], groups[:, end] - groups[:, begin])
        codes[place] = base + 2 * ids.astype(np.int64) + closing
    return [b"".join(engine.written[codes[s:e]].tolist())[:-1] for s, e in zip(rows_a[:-1] + rows_b[:-1], rows_a[1:] + rows_b[1:])]


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", columns: list[str] | None = None, digest: bool = False) -> DataFrame:
    """One row for each row: the named columns (default: all) and what its alignment gives.

    ``n_a``, ``n_b``: tokens of the byte-level BPE file ``path_a`` for the text
    with a blank before it, and of the sentencepiece model ``path_b`` for the
    text. ``n_groups``, ``n_links``; ``groups``: ids as ``a1,a2|b1;a3|b2,b3``, or
    with ``digest`` the SHA-256 of that in lowercase hex. ``n_best``: links
    whose pair of ids is held by as many rows as any pair of the same A id;
    ``count_sum``: the sum over all links of the rows that hold their pair.

    Texts that are NULL or empty, or that a tokenizer doesn't give back byte by
    byte, have no tokens: zeros and an empty ``groups``. Repeated rows count
    each. Long texts are aligned whole. An empty table gives no rows. Columns
    of these names in ``df`` are replaced.
    """
    bound_batches(df.sparkSession)
    made = [part.split()[0] for part in _MADE.split(", ")] + ["n_best", "count_sum"]
    keep = [c for c in (df.columns if columns is None else columns) if c not in made]
    carried = df.select(*[col(c) for c in keep])
    taken = carried.select("*", *[F.lit(0).alias(m) for m in made])
    body, chunk, own, times, pairs, docs = unused(taken, "text__", "chunk__", "own__", "times__", "pairs__", "docs__")
    schema = T.StructType(carried.schema.fields + T.StructType.fromDDL(
        f"{_MADE}, {chunk} long, {own} binary, {times} binary, {pairs} array<long>, {docs} array<int>").fields)
    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, number = encoders(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in _slices(batches, body):
            ids_a, rows_a, ids_b, rows_b = engine.encode(batch[body].to_pylist())
            sizes_a, sizes_b = engine.size_a[ids_a], engine.size_b[ids_b]
            groups = lockstep(_ends(sizes_a, rows_a), rows_a, _ends(sizes_b, rows_b), rows_b)
            doc = np.searchsorted(rows_a, groups[:, 0], "right") - 1
            holder, pair, often = links(groups, doc, ids_a, ids_b, width)
            distinct, place, held = np.unique(pair, return_inverse=True, return_counts=True)
            row = np.searchsorted(holder, np.arange(batch.num_rows + 1))
            place, often = place.astype("<u4"), often.astype("<u4")
            written = _written(engine, groups, ids_a, rows_a, ids_b, rows_b)
            written = [(hashlib.sha256(w).hexdigest() if digest else w.decode()) if w else "" for w in written]
            n_links = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
            total = np.concatenate([[0], np.cumsum(n_links)])[np.searchsorted(doc, np.arange(batch.num_rows + 1))]
            values = [
                pa.array(np.diff(rows_a)), pa.array(np.diff(rows_b)), pa.array(np.bincount(doc, minlength=batch.num_rows)), pa.array(np.diff(total)),
                pa.array(written, pa.string()), pa.array(np.full(batch.num_rows, number)),
                pa.array([place[s:e].tobytes() for s, e in zip(row, row[1:])], pa.binary()),
                pa.array([b"" if (often[s:e] == 1).all() else often[s:e].tobytes() for s, e in zip(row, row[1:])], pa.binary()),
                pa.nulls(batch.num_rows, pa.list_(pa.int64())), pa.nulls(batch.num_rows, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + values, names=schema.names)
            lists = {pairs: pa.array([distinct], pa.list_(pa.int64())), docs: pa.array([held.astype(np.int32)], pa.list_(pa.int32())), chunk: pa.array([number])}
            types = [batch.schema.field(c).type for c in keep] + [v.type for v in values]
            yield pa.RecordBatch.from_arrays([lists[n] if n in lists else pa.nulls(1, t) for n, t in zip(schema.names, types)], names=schema.names)
            number += 1

    done = df.select(*[col(c) for c in keep], col(text).alias(body)).mapInArrow(merged, schema)
    done = materialise(done, "aligned", compression="zstd")
    rows, lists = done.filter(col(own).isNotNull()), done.filter(col(pairs).isNotNull())
    listed = lists.select(col(chunk).alias("chunk"), F.posexplode(F.arrays_zip(col(pairs).alias("pair"), col(docs).alias("held"))).alias("place", "link"))
    listed = listed.select("chunk", "place", "link.pair", "link.held")
    counts = listed.groupBy("pair").agg(F.sum("held").alias("count"))
    a = F.floor(F.col("pair") / F.lit(width))
    most = counts.groupBy(a.alias("a")).agg(F.max("count").alias("most"))
    counts = counts.join(most, a == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    # Every batch gets the counts of its own links, in the order of its list.
    back = listed.join(counts, "pair").select(F.col("chunk").alias(chunk), "place", "count", "best")
    out = T.StructType([f for f in schema if f.name not in (chunk, own, times, pairs, docs)] + T.StructType.fromDDL("n_best long, count_sum long").fields)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        count, best = np.zeros(size, np.int64), np.zeros(size, bool)
        place = right["place"].to_numpy()
        count[place], best[place] = right["count"].to_numpy(), right["best"].to_numpy()
        n_best, total = [], []
        for mine, often in zip(left[own].to_pylist(), left[times].to_pylist()):
            mine = np.frombuffer(mine, "<u4")
            often = np.frombuffer(often, "<u4").astype(np.int64) if often else np.ones(len(mine), np.int64)
            n_best.append(int(often[best[mine]].sum()))
            total.append(int((count[mine] * often).sum()))
        columns = [left[f.name] for f in out.fields[:-2]] + [pa.array(n_best, pa.int64()), pa.array(total, pa.int64())]
        return pa.table(columns, names=out.names)

    return rows.drop(pairs, docs).groupBy(chunk).cogroup(back.groupBy(chunk)).applyInArrow(scored, out)


def _ends(sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The byte after each token within its document."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    return total[1:] - np.repeat(total[rows[:-1]], np.diff(rows))


def _slices(batches: Iterator[pa.RecordBatch], body: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``_AT_ONCE`` bytes of text, or of one longer text."""
    for whole in batches:
        sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(whole[body]), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < whole.num_rows:
            limit = (sizes[begin - 1] if begin else 0) + _AT_ONCE
            part = whole.slice(begin, max(1, int(np.searchsorted(sizes, limit)) - begin))
            begin += part.num_rows
            yield part
