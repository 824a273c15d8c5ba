"""Exact token counts of every word prefix of a text, and the answers they give."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bindings.common import Catalog
from vereda.llm.common import documents, raw

catalog = Catalog()

TOKENIZER = "word_bpe_49k.json"


def cuts_at_spaces(rules: dict) -> bool:
    """Whether a tokenizer's rules drop white space before they merge."""
    steps = [rules.get("pre_tokenizer") or {}]
    steps += steps[0].get("pretokenizers", [])
    return any(s.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer") or s.get("type") == "Split" and s.get("behavior") == "Removed" for s in steps)


class WordTokens(dict):
    """Token count of a word from the tokenizer itself, remembered per worker; forgets when full."""

    limit = 1_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            if not cuts_at_spaces(json.load(f)):
                raise ValueError("tokens of this tokenizer may span words, so counts of words do not add up")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = n = len(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return n


_known: dict[str, WordTokens] = {}


def prefix_table(text: bytes, counts: WordTokens) -> np.ndarray:
    """``table[i]`` is the token count of the text's first ``i`` words.

    The tokenizer cuts at white space before it merges, so no token spans two
    words and ``table[i] = table[i - 1] + tokens(word i)`` holds exactly.
    """
    words = text.split()
    table = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(counts.__getitem__, words), np.int64, len(words)), out=table[1:])
    return table


def longest_within(table: np.ndarray, budget: int) -> int:
    """How many leading words fit ``budget`` tokens, by bisection of the table."""
    return int(np.searchsorted(table, budget, side="right")) - 1


def _tables(path: str):
    counts = _known.get(path)
    if counts is None:
        counts = _known[path] = WordTokens(path)
    return counts


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, prefix_tokens``: per document the count at every word
    prefix (the first entry, 0, is the empty prefix). NULL and blank texts have
    the one entry 0. Any number of rows per ``doc_id`` is allowed; each row is
    answered by itself. Other columns are ignored.
    """
    path = path or default_path()

    def run(batches):
        counts = _tables(path)
        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            tables = [prefix_table(t, counts) for t in texts]
            ends = np.cumsum([0] + [len(t) for t in tables]).astype(np.int32)
            values = pa.array(np.concatenate(tables).astype(np.int32) if tables else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values)],
                names=["doc_id", "n_bytes", "prefix_tokens"],
            )

    return raw(docs).mapInArrow(run, "doc_id long, n_bytes long, prefix_tokens array<int>")


def budget_answers(docs: DataFrame, limit: int, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fitting_words, fitting_tokens``: the
    whole count, and the longest word prefix within ``limit``, read off the prefix
    table where it is made; the table itself is not stored."""
    path = path or default_path()

    def run(batches):
        counts = _tables(path)
        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            total, fit, used = [], [], []
            for t in texts:
                table = prefix_table(t, counts)
                i = longest_within(table, limit)
                total.append(int(table[-1]))
                fit.append(i)
                used.append(int(table[i]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in ([len(t) for t in texts], total)),
                 pa.array([n > limit for n in total], pa.bool_()), *(pa.array(x, pa.int64()) for x in (fit, used))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_words", "fitting_tokens"],
            )

    return raw(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_words long, fitting_tokens long"
    )


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@catalog.add()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole counts against a limit of 2048 tokens, from the prefix tables."""
    return budget_answers(documents(spark, sf_dir), 2048)
