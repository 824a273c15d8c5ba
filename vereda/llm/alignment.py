"""Alignment of two tokenizers over the same texts.

Both token sequences of a text are lists of byte offsets at which tokens end. A
galloping intersection walks the shorter list and finds each of its ends in the
longer one by exponential, then binary search, for all ends of some texts side by
side. Ends found in both slice the tokens into groups; the difference of two
neighbours' ranks is the range of the other side's tokens that a token overlaps.

Linked pairs of ids are counted over all documents by Spark and looked up again:
in sorted arrays while the pairs stay below ``BROADCAST_PAIRS``, else by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindings.common import Catalog
from vereda.llm.common import documents, raw, slices, task_id
from vereda.session import materialize

catalog = Catalog()

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: pairs that are sent to the tasks as arrays of 13 bytes each, at most
BROADCAST_PAIRS = 6_000_000
#: tokens of words that a worker remembers, and pairs that a counting task holds, before they go
REMEMBERED, HELD_PAIRS = 3_000_000, 6_000_000
#: bits of an id of B in a pair's number
B_BITS = 15
#: a space that begins a token of both sides: it follows no space and precedes no white space
CUT = re.compile(r"(?<=[^ ]) (?=\S)")


def byte_values() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1
    for itself, the others from U+0100 on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level tokenizer; special strings in texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        size, values = self.tokenizer.get_vocab_size(), byte_values()
        self.bytes = [b""] * size
        for piece, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(values[c] for c in piece) if all(c in values for c in piece) else piece.encode()
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        splits = rules["pre_tokenizer"] or {}
        self.cuts = rules["normalizer"] is None and splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [bytes([int(p[1:-1], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """Tokens of the words that a worker has met, one after the other."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.lengths = np.array([len(b) for b in tokenizer.bytes])
        self.clear()

    def clear(self) -> None:
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str], raw_words: list[bytes]) -> np.ndarray:
        """Adds ``words``; which of them their tokens spell byte by byte."""
        found = self.tokenizer.encode(words)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(counts) - counts)
        self.counts = np.append(self.counts, counts)
        self.ids = np.append(self.ids, np.fromiter((i for x in found for i in x), np.int32, int(counts.sum())))
        spell = self.tokenizer.bytes
        return np.fromiter((b"".join([spell[i] for i in x]) == w for x, w in zip(found, raw_words, strict=True)), bool, len(found))

    def tokens(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words' tokens in order, and how many each word has."""
        n = self.counts[words]
        at = np.repeat(self.starts[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.ids[at], n


def gallop(wanted: np.ndarray, among: np.ndarray, low: np.ndarray, high: np.ndarray, hint: np.ndarray) -> np.ndarray:
    """For each ``wanted`` the first place in ``[low, high]`` where the ascending ``among``
    is not below it (it is not at ``high``): doubling steps from ``hint``, then bisection."""
    low, high, hint = low.copy(), high.copy(), np.clip(hint, low, high)
    below = among[hint] < wanted
    low[below] = hint[below] + 1
    high[~below] = hint[~below]
    step = 1
    for up in (True, False):
        lanes, step = np.flatnonzero((below == up) & (low < high)), 1
        while len(lanes):
            probe = np.clip(hint[lanes] + (step if up else -step), low[lanes], high[lanes])
            less = among[probe] < wanted[lanes]
            low[lanes[less]] = probe[less] + 1
            high[lanes[~less]] = probe[~less]
            lanes = lanes[(less if up else ~less) & (low[lanes] < high[lanes])]
            step *= 2
    lanes = np.flatnonzero(low < high)
    while len(lanes):
        middle = (low[lanes] + high[lanes]) >> 1
        less = among[middle] < wanted[lanes]
        low[lanes[less]] = middle[less] + 1
        high[lanes[~less]] = middle[~less]
        lanes = lanes[low[lanes] < high[lanes]]
    return low


def spans(counts: np.ndarray) -> np.ndarray:
    """Edges of consecutive runs."""
    return np.concatenate([[0], np.cumsum(counts)])


class Alignment:
    """Several texts' tokens of both sides, aligned. ``a_ends`` and ``b_ends`` ascend over
    all texts; ``a_edges`` and ``b_edges`` cut them by text; a text's last ends are equal."""

    def __init__(self, a_ends: np.ndarray, b_ends: np.ndarray, a_edges: np.ndarray, b_edges: np.ndarray):
        n_a, n_b = np.diff(a_edges), np.diff(b_edges)
        a_short = n_a <= n_b
        pairs, commons = [], []
        for short, ends, other, edges, other_edges, n, m in (
            (a_short, a_ends, b_ends, a_edges, b_edges, n_a, n_b), (~a_short, b_ends, a_ends, b_edges, a_edges, n_b, n_a)
        ):
            text = np.repeat(np.arange(len(n)), n)
            own = np.flatnonzero(short[text])
            text = text[own]
            rank = own - edges[text]
            hint = other_edges[text] + rank * m[text] // np.maximum(n[text], 1)
            place = gallop(ends[own], other, other_edges[text], other_edges[text + 1] - 1, hint)
            common = other[place] == ends[own]
            # the other side's tokens from behind the last end to the one that covers this end
            after = place + common
            first = np.where(rank > 0, np.append(0, after[:-1]), other_edges[text])
            times = place - first + 1
            inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            pairs.append((np.repeat(own, times), np.repeat(first, times) + inner))
            commons.append((own[common], place[common]))
        (a1, b1), (b2, a2) = pairs
        #: all linked tokens, by place
        self.link_a, self.link_b = np.append(a1, a2), np.append(b1, b2)
        (a1, b1), (b2, a2) = commons
        a, b = np.append(a1, a2), np.append(b1, b2)
        order = np.argsort(a, kind="stable")
        #: tokens that end a group, by place
        self.last_a, self.last_b = a[order], b[order]


DIGITS = np.zeros((1 << 16, 6), np.uint8)
for _k in range(5):
    DIGITS[:, 4 - _k] = np.arange(1 << 16) // 10**_k % 10 + 48
WIDTHS = np.searchsorted([10, 100, 1000, 10_000], np.arange(1 << 16), side="right") + 1


def written(a_ids: np.ndarray, b_ids: np.ndarray, found: Alignment, a_edges: np.ndarray, b_edges: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` for all texts in one line, and where each text begins; a text ends in ``;`` too."""
    n_a, n_b = np.diff(np.append(-1, found.last_a)), np.diff(np.append(-1, found.last_b))
    a_at = np.arange(len(a_ids)) + np.repeat(np.cumsum(n_b) - n_b, n_a)
    b_at = np.arange(len(b_ids)) + np.repeat(np.cumsum(n_a), n_b)
    ids, marks = np.empty(len(a_ids) + len(b_ids), np.int64), np.full(len(a_ids) + len(b_ids), ord(","), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    marks[a_at[found.last_a]], marks[b_at[found.last_b]] = ord("|"), ord(";")
    cells = DIGITS[ids]
    cells[:, 5] = marks
    line = cells[np.arange(6) >= (5 - WIDTHS[ids])[:, None]]
    return line.tobytes(), np.append(0, np.cumsum(WIDTHS[ids] + 1))[a_edges + b_edges]


class Aligner:
    """What a worker knows: both tokenizers and the words it has met."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(ByteLevel(path_a)), Side(Pieces(path_b))
        self.cuts = self.a.tokenizer.cuts and self.b.tokenizer.cuts
        self.place: dict[str, int] = {}
        self.whole = np.zeros(0, bool)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all words and how many each text has; words are cut where no token of either side crosses."""
        parts = [CUT.split(t) if self.cuts else [t] for t in texts]
        if len(self.a.ids) + len(self.b.ids) > REMEMBERED:
            self.place.clear()
            self.whole = self.whole[:0]
            self.a.clear()
            self.b.clear()
        place = self.place
        new = list(dict.fromkeys(w for p in parts for w in p if w not in place))
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            spelled = [b" " + w.encode() for w in some]
            self.whole = np.append(self.whole, self.a.learn(some, spelled) & self.b.learn(some, spelled))
            place.update(zip(some, range(len(place), len(place) + len(some)), strict=True))
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.fromiter((place[w] for p in parts for w in p), np.int64, int(counts.sum())), counts

    def align(self, texts: list[bytes | None]) -> list[tuple]:
        """Per text ``n_a, n_b, n_groups, n_links, n_pairs, digest, pairs, times``."""
        spoken = [(t or b"").decode("utf-8", "replace") for t in texts]
        # bytes that are no UTF-8 can't be spelled
        good = np.fromiter((bool(t) and s.encode() == t for t, s in zip(texts, spoken, strict=True)), bool, len(texts))
        out: list[tuple] = [(0, 0, 0, 0, 0, "", b"", b"")] * len(texts)
        words, counts = self.words([s for s, g in zip(spoken, good, strict=True) if g])
        if not len(counts):
            return out
        edges = spans(counts)
        fine = np.logical_and.reduceat(self.whole[words], edges[:-1])
        words, counts = words[np.repeat(fine, counts)], counts[fine]
        rows = np.flatnonzero(good)[fine]
        if not len(rows):
            return out
        edges = spans(counts)
        (a_ids, n_a), (b_ids, n_b) = self.a.tokens(words), self.b.tokens(words)
        a_edges, b_edges = spans(n_a)[edges], spans(n_b)[edges]
        found = Alignment(np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b.lengths[b_ids]), a_edges, b_edges)
        line, begins = written(a_ids, b_ids, found, a_edges, b_edges)
        text = np.searchsorted(a_edges, found.link_a, side="right") - 1
        code = text.astype(np.uint64) << np.uint64(32) | a_ids[found.link_a].astype(np.uint64) << np.uint64(B_BITS) | b_ids[found.link_b].astype(np.uint64)
        code, times = np.unique(code, return_counts=True)
        cut = np.searchsorted(code, np.arange(len(rows) + 1, dtype=np.uint64) << np.uint64(32))
        groups = np.diff(np.searchsorted(found.last_a, a_edges))
        links = np.bincount(text, minlength=len(rows))
        for k, row in enumerate(rows.tolist()):
            digest = hashlib.sha256(line[begins[k] : begins[k + 1] - 1]).hexdigest()
            own = slice(cut[k], cut[k + 1])
            out[row] = (
                int(a_edges[k + 1] - a_edges[k]), int(b_edges[k + 1] - b_edges[k]), int(groups[k]), int(links[k]), int(cut[k + 1] - cut[k]), digest,
                packed(code[own].astype(np.uint32)), pa.compress(times[own].astype(np.uint32), codec="zstd", asbytes=True),
            )
        return out


def packed(codes: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte in turn, compressed."""
    steps = np.diff(codes, prepend=np.uint32(0)).astype(np.uint32)
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(n: int, codes: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    steps = np.frombuffer(pa.decompress(codes, 4 * n, codec="zstd"), np.uint8).reshape(4, -1).T.copy().view(np.uint32)
    return np.cumsum(steps.ravel(), dtype=np.int64), np.frombuffer(pa.decompress(times, 4 * n, codec="zstd"), np.uint32).astype(np.int64)


_known: dict[tuple, Aligner] = {}


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and the row's distinct
    linked pairs: their number ``n_pairs`` and packed ``pairs`` and ``times``."""
    paths = (path_a or default_path(TOKENIZER_A), path_b or default_path(TOKENIZER_B))
    names = "row doc_id n_a n_b n_groups n_links n_pairs groups_sha256 pairs times".split()

    def run(batches):
        aligner = _known.get(paths)
        if aligner is None:
            aligner = _known[paths] = Aligner(*paths)
        row = task_id() << 33
        for b in slices(batches):
            found = aligner.align(b.column("text").to_pylist())
            *numbers, digests, pairs, times = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(found)), pa.int64()), b.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers),
                 pa.array(digests, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                names=names,
            )
            row += len(found)

    numbers = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_pairs long"
    return raw(docs).mapInArrow(run, f"{numbers}, groups_sha256 string, pairs binary, times binary")


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many rows each pair of ids is linked, and whether that is
    the most of its A id. Tasks count their rows' pairs before the shuffle."""

    def run(batches):
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def merged():
            pairs, inverse = np.unique(np.concatenate(held), return_inverse=True)
            return pairs, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)

        size = 0
        for b in batches:
            for n, pairs, times in zip(*(b.column(c).to_pylist() for c in ("n_pairs", "pairs", "times")), strict=True):
                held.append(unpacked(n, pairs, times)[0])
                counts.append(np.ones(n))
                size += n
                if size > HELD_PAIRS:
                    pairs, n = merged()
                    held, counts, size = [pairs], [n], len(pairs)
                    if size > HELD_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])
                        held, counts, size = [], [], 0
        if held:
            pairs, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    counts = found.select("n_pairs", "pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "align-counts").withColumn("a", F.shiftright("pair", B_BITS))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return materialize(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "align-pairs")


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _looked_up(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sums of each row's links in sorted arrays of all pairs."""
    table = pairs.toPandas()
    order = np.argsort(table["pair"].to_numpy())
    arrays = found.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("pair", "n", "best")))

    def run(batches):
        keys, n, best = arrays.value
        for b in batches:
            sums = []
            for k, p, t in zip(*(b.column(c).to_pylist() for c in ("n_pairs", "pairs", "times")), strict=True):
                p, t = unpacked(k, p, t)
                at = np.searchsorted(keys, p)
                sums.append((int(t[best[at]].sum()), int((t * n[at]).sum())))
            n_best, count_sum = zip(*sums, strict=True) if sums else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", *NUMBERS)), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), b.column("groups_sha256")],
                names=["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"],
            )

    schema = ", ".join(f"{c} long" for c in ("doc_id", *NUMBERS, "n_best", "count_sum"))
    return found.mapInArrow(run, f"{schema}, groups_sha256 string")


def _joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same by a join of all rows' pairs with the counts, for any number of pairs."""

    def run(batches):
        for b in batches:
            for row, k, p, t in zip(*(b.column(c).to_pylist() for c in ("row", "n_pairs", "pairs", "times")), strict=True):
                if k:
                    p, t = unpacked(k, p, t)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(k, row)), pa.array(p), pa.array(t)], names=["row", "pair", "times"])

    links = found.select("row", "n_pairs", "pairs", "times").mapInArrow(run, "row long, pair long, times long").join(pairs, "pair")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    known = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return found.join(sums, "row", "left").select("doc_id", *NUMBERS, *known, "groups_sha256")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row.

    A row's pair counts once however often it stands in the text; rows count one by
    one, repeated ones and rows without an id too. Texts that are NULL, empty, no UTF-8
    or not spelled byte by byte by both sides have no tokens: zeros and an empty digest.
    Ids that tie for the most are all best. Texts count whole: a task aligns about 1 MB
    of text at once, or one longer text with some 300 bytes of memory for each of its
    bytes. An empty table gives no rows. Other columns are left behind.
    """
    found = materialize(aligned(docs, path_a, path_b), "aligned")
    pairs = pair_counts(found)
    return (_looked_up if pairs.count() <= most_pairs else _joined)(found, pairs)


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@catalog.add()
def op12_aligned_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the byte-level and the piece tokenizer."""
    return align(documents(spark, sf_dir))
