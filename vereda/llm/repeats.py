"""Passages that recur across documents, found by window hashes and located by
Aho-Corasick automata.

Documents are packed into chunks, and every step exchanges packed arrays between
chunks and hash ranges, one entry per distinct hash and chunk. A passage that a
third of all documents share is therefore one entry per chunk, never a hot key.

1. Anchors: in each document the smallest 5-word hash of every 13-word window.
   Equal windows have equal anchors, and an anchor stands for about five windows.
   Anchors met in two documents come back to their chunks as bits.
2. Only windows whose anchor recurs are hashed and exchanged; back comes one bit:
   whether a document of another chunk with a smaller id has the window.
3. Each chunk compiles the windows it must remove somewhere into one automaton
   over words (a character per distinct word) and streams its documents through.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, gram_hashes, hashed_words, mixed, raw, task_id
from vereda.session import materialize

catalog = Catalog()

WINDOW, ANCHOR = 13, 5
CHUNK_BYTES, CHUNK_ROWS = 512 * 1024, 4096
#: entries of one hash range, on average
RANGE_ENTRIES = 250_000
NO_ID = np.iinfo(np.int64).max


def packed(docs: DataFrame) -> DataFrame:
    """``chunk, n_bytes, payload``: the rows of a scan in chunks of at most 512 KB of
    text (or one longer document), compressed."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])

    def seal(rows):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema))
        return sink.getvalue().to_pybytes()

    def run(batches):
        number, rows, size = task_id() << 32, [], 0
        for b in batches:
            for row in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                n = len(row[1] or b"")
                if rows and (size + n > CHUNK_BYTES or len(rows) >= CHUNK_ROWS):
                    yield pa.RecordBatch.from_pydict({"chunk": [number], "n_bytes": [size], "payload": [seal(rows)]})
                    number, rows, size = number + 1, [], 0
                rows.append(row)
                size += n
        if rows:
            yield pa.RecordBatch.from_pydict({"chunk": [number], "n_bytes": [size], "payload": [seal(rows)]})

    return raw(docs).mapInArrow(run, "chunk long, n_bytes long, payload binary")


class Chunk:
    """The documents of a chunk as one line of word hashes."""

    def __init__(self, payload: bytes):
        table = pa.ipc.open_stream(payload).read_all()
        self.rows = table.column("doc_id").to_pylist()
        self.ids = np.array([NO_ID if i is None else i for i in self.rows], np.int64)
        self.texts = [t or b"" for t in table.column("text").to_pylist()]
        self.hashes, self.owner = hashed_words(self.texts)
        m = max(len(self.hashes) - WINDOW + 1, 0)
        #: first words of the windows, none across two documents
        self.starts = np.flatnonzero(self.owner[:m] == self.owner[WINDOW - 1 :][:m])
        g = gram_hashes(self.hashes, ANCHOR)
        low = g[:m].copy()
        for k in range(1, WINDOW - ANCHOR + 1):
            np.minimum(low, g[k : k + m], out=low)
        # the least of several hashes is small, so it is mixed again before it names a range
        self.anchors = mixed(low[self.starts])

    def anchor_codes(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor codes of 32 + ``bits`` bits, and which of them two documents have."""
        mine, owner = self.anchors >> np.uint64(32 - bits), self.owner[self.starts]
        order = np.lexsort((owner, mine))
        mine, owner = mine[order], owner[order]
        heads = np.flatnonzero(np.diff(mine, prepend=~mine[:1]) != 0)
        last = np.append(heads[1:], len(mine)) - 1
        return mine[heads], owner[heads] != owner[last] if len(heads) else np.zeros(0, bool)

    def recurring(self, bits: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, document and first word of every window whose anchor has one of ``codes``."""
        mine = self.anchors >> np.uint64(32 - bits)
        found = np.zeros(len(mine), bool)
        if len(codes):
            found = codes[np.minimum(np.searchsorted(codes, mine), len(codes) - 1)] == mine
        p = self.starts[found]
        return gram_hashes(self.hashes, WINDOW)[p], self.owner[p], p


def first_owners(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, their smallest and largest id, and where each input stands."""
    distinct, at = np.unique(hashes, return_inverse=True)
    low, high = np.full(len(distinct), NO_ID), np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, at, ids)
    np.maximum.at(high, at, ids)
    return distinct, low, high, at


def spans(codes: np.ndarray, shift: int, bits: int):
    """Slices of sorted codes by their upper ``bits`` bits."""
    which = (codes >> np.uint64(shift)).astype(np.int64) if bits else np.zeros(len(codes), np.int64)
    starts = np.flatnonzero(np.diff(which, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(codes)], strict=True):
        yield int(which[a]), a, b


def bits_of(marks) -> bytes:
    return np.packbits(np.asarray(marks, bool)).tobytes()


def unpacked(parts, lengths) -> np.ndarray:
    """Marks of a chunk from its ranges' bits, in the order of the ranges."""
    out = [np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(bool) for p, n in zip(parts, lengths, strict=True)]
    return np.concatenate([*out, np.zeros(0, bool)])


def all_marks(codes: np.ndarray, shift: int, bits: int, parts: list[bytes] | None) -> np.ndarray:
    return unpacked(parts or [], [b - a for _, a, b in spans(codes, shift, bits)])


def anchor_requests(chunks: DataFrame, bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for number, payload in zip(batch.column("chunk").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                codes, twice = Chunk(payload).anchor_codes(bits)
                out = [(r, number, codes[a:b].astype(np.uint32).tobytes(), bits_of(twice[a:b])) for r, a, b in spans(codes, 32, bits)]
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(("range", "chunk", "keys", "twice"), map(list, zip(*out, strict=True)), strict=True)))

    return chunks.mapInArrow(run, "range long, chunk long, keys binary, twice binary")


def answer_anchors(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Which keys of a range occur in two documents or more, as bits per chunk."""
    keys = [np.frombuffer(k, np.uint32) for k in pdf["keys"]]
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(k)) for t, k in zip(pdf["twice"], keys, strict=True)])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    found = (np.bincount(at, weights=1.0 + twice, minlength=len(distinct)) >= 2)[at]
    ends = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"chunk": pdf["chunk"], "range": pdf["range"], "bits": [bits_of(m) for m in np.split(found, ends)]})


def window_requests(marked: DataFrame, bits: int, wide: int) -> DataFrame:
    """Distinct recurring windows of each chunk with the smallest id that has them
    there; ids are sent once per row and windows point to them."""

    def run(batches):
        for batch in batches:
            for number, payload, marks in zip(*(batch.column(c).to_pylist() for c in ("chunk", "payload", "anchor_marks")), strict=True):
                c = Chunk(payload)
                codes = c.anchor_codes(bits)[0]
                h, d, _ = c.recurring(bits, codes[all_marks(codes, 32, bits, marks)])
                distinct, low, _, _ = first_owners(h, c.ids[d])
                out = []
                for r, a, b in spans(distinct, 64 - wide if wide else 0, wide):
                    ids, which = np.unique(low[a:b], return_inverse=True)
                    out.append((r, number, distinct[a:b].tobytes(), which.astype(np.uint16).tobytes(), ids.tobytes()))
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(("range", "chunk", "keys", "owner", "ids"), map(list, zip(*out, strict=True)), strict=True)))

    return marked.mapInArrow(run, "range long, chunk long, keys binary, owner binary, ids binary")


def answer_windows(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk, which of its windows a document with a smaller id has elsewhere."""
    keys = [np.frombuffer(k, np.uint64) for k in pdf["keys"]]
    own = np.concatenate([np.frombuffer(i, np.int64)[np.frombuffer(o, np.uint16)] for i, o in zip(pdf["ids"], pdf["owner"], strict=True)])
    _, low, _, at = first_owners(np.concatenate(keys), own)
    ends = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"chunk": pdf["chunk"], "range": pdf["range"], "bits": [bits_of(m) for m in np.split(low[at] < own, ends)]})


def by_chunk(answers: DataFrame, name: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("range", "bits")))
    return answers.groupBy("chunk").agg(F.transform(parts, lambda p: p["bits"]).alias(name))


def runs_of(p: np.ndarray, d: np.ndarray, limit: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of neighbouring windows of one document with one limit: first word, end, limit."""
    if not len(p):
        return []
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(p) != 1) | (np.diff(d) != 0) | (limit[1:] != limit[:-1])]))
    last = np.append(heads[1:], len(p)) - 1
    return list(zip(p[heads].tolist(), (p[last] + WINDOW).tolist(), limit[heads].tolist(), strict=True))


def covered(c: Chunk, p: np.ndarray, d: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Marks the words to remove.

    Passages (runs of removable windows) are compiled into one automaton over
    words, each distinct word a character, and all documents of the chunk stream
    through it. An occurrence counts in documents with an id above its limit; all
    windows of a passage have the passage's limit.
    """
    import ahocorasick

    number = np.unique(c.hashes, return_inverse=True)[1] + 1
    line = (number + np.where(number >= 0xD800, 0x800, 0)).astype("<u4").tobytes().decode("utf-32-le")
    machine = ahocorasick.Automaton()
    for a, b, most in runs_of(p, d, limit):
        machine.add_word(line[a:b], (b - a, most))
    edge = np.zeros(len(line) + 1, np.int64)
    if len(machine):
        machine.make_automaton()
        first = np.searchsorted(c.owner, np.arange(len(c.ids) + 1)).tolist()
        for i, doc_id in enumerate(c.ids.tolist()):
            if first[i + 1] - first[i] >= WINDOW:
                for end, (n, most) in machine.iter(line[first[i] : first[i + 1]]):
                    if doc_id > most:
                        edge[first[i] + end + 1 - n] += 1
                        edge[first[i] + end + 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def removals(marked: DataFrame, bits: int, wide: int, with_text: bool) -> DataFrame:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text

    def run(batches):
        for batch in batches:
            for payload, anchor_marks, window_marks in zip(*(batch.column(x).to_pylist() for x in ("payload", "anchor_marks", "window_marks")), strict=True):
                c = Chunk(payload)
                codes = c.anchor_codes(bits)[0]
                h, d, p = c.recurring(bits, codes[all_marks(codes, 32, bits, anchor_marks)])
                distinct, low, _, at = first_owners(h, c.ids[d])
                elsewhere = all_marks(distinct, 64 - wide if wide else 0, wide, window_marks)
                # a document loses the window if its id is above the limit
                limit = np.where(elsewhere, np.iinfo(np.int64).min, low)[at]
                lost = c.ids[d] > limit
                gone = covered(c, p[lost], d[lost], limit[lost])
                first = np.searchsorted(c.owner, np.arange(len(c.ids) + 1))
                out = []
                for i, (doc_id, text) in enumerate(zip(c.rows, c.texts, strict=True)):
                    words, mine = text.split(), gone[first[i] : first[i + 1]]
                    n = int(mine.sum())
                    kept = b" ".join(words if not n else [w for w, g in zip(words, mine.tolist(), strict=True) if not g])
                    out.append((doc_id, len(words), n, hashlib.sha256(kept).hexdigest(), *[kept.decode("utf-8", "replace")] * with_text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in list(zip(*out, strict=True))[:3]] + [pa.array(x, pa.string()) for x in list(zip(*out, strict=True))[3:]], names=names
                )

    return marked.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text``): each document
    without the words covered by a 13-word window that also starts in a document
    with a smaller id.

    NULL and blank texts have no words. A NULL id counts as larger than all others
    and equal to itself. Rows that share an id are judged alike: neither removes
    from the other. Words are compared as bytes; hashes of windows have 64 bits.
    """
    chunks = materialize(packed(docs), "repeat-chunks")
    # five bytes a word and an anchor for every fifth word
    entries = (chunks.agg(F.sum("n_bytes")).first()[0] or 0) / 25
    bits = max(0, math.ceil(math.log2(max(entries, 1) / RANGE_ENTRIES)))
    asked = anchor_requests(chunks.select("chunk", "payload"), bits)
    anchors = asked.groupBy("range").applyInPandas(answer_anchors, "chunk long, range long, bits binary")
    anchor_marks = materialize(by_chunk(anchors, "anchor_marks"), "repeat-anchors")
    marked = chunks.select("chunk", "payload").join(anchor_marks, "chunk", "left")
    asked = window_requests(marked, bits, bits)
    windows = asked.groupBy("range").applyInPandas(answer_windows, "chunk long, range long, bits binary")
    window_marks = materialize(by_chunk(windows, "window_marks"), "repeat-windows")
    return removals(marked.join(window_marks, "chunk", "left"), bits, bits, with_text)


@catalog.add()
def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has."""
    return remove_repeats(documents(spark, sf_dir))
