"""The training-data operators on small tables with every awkward case, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from vereda.llm import (
    chat, decontamination, language_model, mixing, near_duplicates, queries, repeats, search, sharding, token_counts, toxicity,
)
from vereda.llm.common import hashed_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row long, key string, rank int"
VOCABULARY = [f"w{i}x" for i in range(400)]


def make_rows():
    r = random.Random(5)
    passage = " ".join(r.choices(VOCABULARY, k=40))
    rows = []
    for i in range(60):
        words = r.choices(VOCABULARY, k=r.choice([3, 30, 90]))
        text = " ".join(words)
        if i % 6 == 0:
            text = f"{text} {passage}\n{text[:20]}"
        rows.append((i, text, r.choice(["en", "de", None]), r.choice(["a", "b", "B", None]), len(text), True, 7, "k", 1))
    for i, base in ((60, 6), (61, 6), (62, 12)):  # copies, one with a word changed
        rows.append((i, rows[base][1] + (" changed" if i == 62 else ""), "en", "a", 1, True, 7, "k", 1))
    rows += [(63, None, None, None, None, None, None, None, None), (64, "", "en", "a", 0, True, 1, "", 1), (65, " \t\n", "en", "b", 3, True, 1, "", 1)]
    rows += [(66, "one", "en", "b", 3, True, 1, "", 1), (67, "ONE", "en", "b", 3, True, 1, "", 1), (68, " ".join(r.choices(VOCABULARY, k=30_000)), "en", "b", 1, True, 1, "", 1)]
    rows += [rows[3], rows[3]]
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    b = (text or "").encode()
    return (b.lower() if lower else b).split()


def test_word_hashes_follow_words():
    texts = [t.encode() for _, t, *_ in ROWS if t is not None]
    hashes, owner = hashed_words(texts)
    flat = [(i, w) for i, t in enumerate(texts) for w in t.split()]
    assert owner.tolist() == [i for i, _ in flat]
    assert len({*zip(hashes.tolist(), (w for _, w in flat))}) == len({w for _, w in flat}) == len(set(hashes.tolist()))


def test_token_counts(docs, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.default_path())
    got = sorted(tuple(r) for r in token_counts.budget_answers(docs, 100).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())
    want = sorted((i, len((x or "").encode()), n, n > 100) for i, x, *_ in ROWS for n in [len(t.encode(x or "", add_special_tokens=False).ids)])
    assert got == want
    for r in token_counts.prefix_counts(docs.where("doc_id < 5")).collect():
        ws = words(ROWS[r["doc_id"]][1])
        assert r["prefix_tokens"] == [len(t.encode(b" ".join(ws[:i]).decode(), add_special_tokens=False).ids) for i in range(len(ws) + 1)]
    assert token_counts.budget_answers(nothing, 5).count() == 0


def test_tokenizers_that_span_words_are_refused(tmp_path):
    import json

    import public_tokenizers

    with pytest.raises(ValueError, match="span words"):
        token_counts.WordTokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert token_counts.cuts_at_spaces(json.load(open(token_counts.default_path())))


def test_token_counts_of_awkward_texts(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.default_path())
    texts = ["don't STOP", "naïve façade ÜNTER", "<|endoftext|> <|startoftext|>x", "日本語 テキスト😀", "a\u3000b\u00a0c\u2028d", "12,345.6 7x", "e\u0301 \u200b y", "\x00a\x1cb"]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.budget_answers(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 9).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_repeats(docs, nothing):
    first = {}
    for i, t, *_ in ROWS:
        ws = words(t)
        for p in range(len(ws) - 12):
            g = tuple(ws[p : p + 13])
            first[g] = min(first.get(g, i), i)
    want = []
    for i, t, *_ in ROWS:
        ws = words(t)
        gone = {q for p in range(len(ws) - 12) if first[tuple(ws[p : p + 13])] < i for q in range(p, p + 13)}
        kept = b" ".join(w for q, w in enumerate(ws) if q not in gone)
        want.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    assert sum(w[2] for w in want) > 300
    assert sorted(tuple(r) for r in repeats.remove_repeats(docs).collect()) == sorted(want)
    assert repeats.remove_repeats(nothing).count() == 0


def shingles(text, width=2):
    ws = words(text, True)
    return frozenset(zip(*(ws[k:] for k in range(width)))) if len(ws) >= width else frozenset([tuple(ws)] if ws else [])


def components_of(rows, width=2):
    sets = {i: shingles(t, width) for i, t, *_ in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y) and root(a) != root(b):
            top[max(root(a), root(b))] = min(root(a), root(b))
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_near_duplicates(spark, docs, nothing):
    want = components_of(ROWS)
    got = near_duplicates.near_duplicates(docs, 2).collect()
    assert len(got) == len(ROWS) and all(tuple(r)[1:] == want[r["doc_id"]] for r in got)
    assert near_duplicates.near_duplicates(nothing).count() == 0
    want = components_of(ROWS, 5)
    assert all(tuple(r)[1:] == want[r["doc_id"]] for r in near_duplicates.near_duplicates(docs).collect())
    # a broad group around the limit: many members lie below 0.8 of the pivots
    r = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(w if r.random() > i % 9 / 100 else f"n{r.random()}" for w in base)) for i in range(120)]
    want = components_of(rows)
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert all(tuple(x)[1:] == want[x["doc_id"]] for x in got)


def test_near_duplicates_without_ids(spark):
    r = random.Random(6)
    a, b, c, d, e = (" ".join(r.choices(VOCABULARY, k=60)) for _ in range(5))
    rows = [(None, a, 0), (None, f"{a} more", 1), (None, b, 2), (1, f"{b} more", 3), (None, c, 4), (7, d, 5), (7, e, 6), (8, f"{e} more", 7), (7, d, 8)]
    rows += [(None, None, 9), (None, "", 10), (None, "", 11), (9, " ", 12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, row long")
    got = Counter(tuple(x)[::2] + (x["kept"],) for x in near_duplicates.near_duplicates(table, 2).collect())
    assert got[None, 1, False] == 1 and got[1, 1, True] == 1 and got[8, 7, False] == 1 and got[7, 7, True] == 3
    assert got[None, None, True] == 1 + 1 + 3 and got[None, None, False] == 1 and got[9, 9, True] == 1
    kept = sorted(x["row"] for x in corpus_pipeline.one_of_each(spark, table, "").collect())
    assert len(set(kept) & {0, 1}) == 1 and len(set(kept) & {5, 8}) == 1
    assert set(kept) - {0, 1, 5, 8} == {3, 4, 6, 9, 10, 11, 12} and len(kept) == 9


def test_links_inside_a_cell():
    r = np.random.default_rng(2)
    pool = np.unique(r.integers(0, 1 << 63, 6000, dtype=np.uint64))
    sets = [r.choice(pool, n, replace=False) for n in (1, 40, 3000, 5000, 40)]
    got = near_duplicates.common_members([x.tobytes() for x in sets[:3]], [y.tobytes() for y in sets[3:]])
    assert (got == [[len(np.intersect1d(x, y)) for y in sets[3:]] for x in sets[:3]]).all()
    keep = near_duplicates.spanning(np.array([1, 2, 1, 4]), np.array([2, 3, 3, 1]))
    assert keep.tolist() == [True, True, False, True]


def test_sketch_fills_every_coordinate():
    values = np.arange(1, 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    cells = near_duplicates.sketches(values, np.array([0, 1, 1]), 3)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (cells[:2] != full).all() and (cells[2] == full).all()


def test_sharding(docs, nothing):
    got = sharding.shard_by_hilbert(docs, ["source", "lang", "size"], 7).toPandas()
    counts = got.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert len(counts) == 7 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    want = sorted((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert sorted(got[["doc_id", "size", "text_crc32"]].itertuples(index=False, name=None)) == want
    assert got.sort_values(["shard", "slot"]).hilbert.is_monotonic_increasing
    assert sharding.shard_by_hilbert(nothing, ["source", "size"], 7).count() == 0


def curve(rows, n_shards, bits):
    """The order of ``(source, lang, size)`` rows by quantile levels, by hand."""
    def levels(values, number):
        known = sorted((v for v in values if v is not None), key=lambda v: v if number else v.encode())
        if number:  # edges as the sketch gives them on few rows: exact
            edges = sorted({known[max(math.ceil(i / 2**bits * len(known)), 1) - 1] for i in range(1, 2**bits)})
            return [sum(e < v for e in edges) if v is not None else 0 for v in values]
        out, before = {}, 0
        held = -1
        rank = 0
        for v in dict.fromkeys(known):
            n = known.count(v)
            low, high = before * 2**bits // len(known), (before + n - 1) * 2**bits // len(known)
            rank += low > held or (before > 0 and wide)
            wide = high > low
            held = high
            out[v] = min(rank, 2**bits - 1)
            before += n
        return [out[v] if v is not None else 0 for v in values]

    points = np.array([levels([r[0] for r in rows], False), levels([r[1] for r in rows], False), levels([r[2] for r in rows], True)]).T
    return sharding.hilbert_index(points, bits)


def test_curve_against_levels_by_hand(spark):
    r = random.Random(9)
    rows = [(i, r.choice(["https://one.example/a", "https://one.example/b", "https://two.example/", "é", None]), r.choice(["en"] * 5 + ["de", "fr"]), "x" * r.choice([1, 5, 9, 100])) for i in range(97)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").repartition(5)
    got = {x["doc_id"]: x for x in sharding.shard_by_hilbert(table, ["source", "lang", "size"], 5, 3).collect()}
    want = curve([(x[1], x[2], len(x[3]) + 8) for x in rows], 5, 3)
    assert [got[i]["hilbert"] for i in range(97)] == want.tolist()
    order = sorted(range(97), key=lambda i: (want[i], i))
    assert [(got[i]["shard"], got[i]["slot"]) for i in order] == [(s, k) for s in range(5) for k in range(len([1 for p in range(97) if p * 5 // 97 == s]))]


def test_shards_hold_the_rows_and_prune(spark, docs, nothing, tmp_path):
    import pyarrow.parquet as pq

    table = docs.withColumnsRenamed({"kept": "shard", "row": "_hash", "key": "low"})
    out = sharding.sharded_documents(table, ["source", "lang"], 7)
    assert out.columns == [c for c in table.columns if c != "shard"] + ["shard", "slot"]
    names = ["doc_id", "text", "source"]
    plain = lambda x: tuple("" if v is None else str(v) for v in x)
    assert sorted(plain(x[n] for n in names) for x in out.collect()) == sorted(plain((x[0], x[1], x[3])) for x in ROWS)
    assert out.select("shard", "slot").distinct().count() == len(ROWS)
    assert sharding.sharded_documents(nothing, ["source"], 7).count() == 0
    big = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id) as text", "concat('https://src', id % 20, '.example') as source", "id % 4 as lang")
    sharding.sharded_documents(big.repartition(4), ["source", "lang"], 16).write.option("maxRecordsPerFile", 250).parquet(str(tmp_path / "out"))
    files = [pq.ParquetFile(f) for f in (tmp_path / "out").glob("*.parquet")]
    at = files[0].schema_arrow.get_field_index("source")
    spans = [(g.column(at).statistics.min, g.column(at).statistics.max) for f in files for g in [f.metadata.row_group(0)]]
    # files that a filter on one source has to read
    assert sum(a <= "https://src7.example" <= z for a, z in spans) <= len(spans) / 2


CLASHING = ["_id", "_k", "_size", "_crc", "_h1", "row", "_row", "_hash", "_pieces", "new_text", "node", "size", "crc", "first"]


def test_stages_keep_columns_of_any_name(spark, sf_dir):
    rows = [(i, t, lang, source, n, *([7] * len(CLASHING))) for i, t, lang, source, n, *_ in [*ROWS[:9], *ROWS[-9:], (None, "no id at all", "en", "a", 1), (None, None, None, None, None)]]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHING))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, sf_dir)
        assert out.columns[: len(table.columns)] == table.columns, name
        found = out.collect()
        assert all(x[c] == 7 for x in found for c in CLASHING) and 0 < len(found) <= len(rows), name
        assert stage(spark, table.limit(0), sf_dir).count() == 0, name


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3)])
def test_hilbert_neighbours_touch(n, bits):
    points = np.stack(np.meshgrid(*[range(2**bits)] * n, indexing="ij"), -1).reshape(-1, n)
    index = sharding.hilbert_index(points, bits)
    assert sorted(index) == list(range(len(points)))
    assert set(np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(1)) == {1}


def test_mixing(spark, docs, nothing):
    mix = mixing.Mix(docs, block=8)
    got = mix.taken().toPandas()
    want = sorted((i, len(words(t))) for i, t, *_ in ROWS)
    assert sorted(got[["doc_id", "size"]].itertuples(index=False, name=None)) == want
    assert (got.taken <= 2 * got["size"]).all()
    sizes = defaultdict(int)
    for _, t, _, s, *_ in ROWS:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [None]
    weight = {s: [3.0, 1.0, 2.0][k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(target[s] for s in above)
        open_ -= above
    target |= {s: level * weight[s] for s in open_}
    by = {i: s for i, _, _, s, *_ in ROWS}
    taken = defaultdict(int)
    for r in got.itertuples():
        assert r.source_size == sizes[by[r.doc_id]] and r.target == pytest.approx(target[by[r.doc_id]])
        taken[by[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 12 for s in order if sizes[s])
    again = mixing.Mix(docs.repartition(2), block=8).taken().groupBy("doc_id").sum("taken").collect()
    assert sorted(map(tuple, again)) == sorted(got.groupby("doc_id").taken.sum().items())
    # each source's slots are dealt to the shards by the drawn counts, in order
    dealt = defaultdict(list)
    for x in mix.slots().orderBy("source_no", "slot").collect():
        dealt[x["source_no"]].append(x["shard"])
    drawn = {x["source_no"]: x["counts"] for x in mix.shard_counts().collect()}
    assert {k: [s for s, n in enumerate(v) for _ in range(n)] for k, v in drawn.items() if sum(v)} == dict(dealt)
    assert len({tuple(v) for v in drawn.values()}) > 1
    assert all((r.taken > 0) == (len(r.shards) > 0) for r in got.itertuples())
    slots = mix.slots()
    assert slots.count() == mix.sources.agg({"slots": "sum"}).first()[0] == slots.select("source_no", "slot").distinct().count()
    out = mixing.mixed_documents(docs.dropDuplicates(["doc_id"]), block=8)
    assert out.columns == docs.columns
    alone = mixing.Mix(docs.dropDuplicates(["doc_id"]), block=8).taken().where("taken > 0").collect()
    assert {r["doc_id"]: len(words(r["text"])) for r in out.collect()} == {r["doc_id"]: r["taken"] for r in alone}
    assert mixing.Mix(nothing).taken().count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def test_language_model(docs, nothing):
    got = language_model.score_texts(docs, vocabulary=100, states=3, rounds=3).toPandas()
    train, counts = [t for i, t, *_ in ROWS if zlib.crc32(str(i).encode()) % 10], Counter()
    for t in train:
        counts.update([*words(t, True), b""])
    n, v = sum(counts.values()), len(counts)
    want = {i: (len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, t, *_ in ROWS for ws in [[*words(t, True), b""]]}
    assert len(got) == len(ROWS) and (got.train_tokens == n).all()
    for r in got.itertuples():
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2] and r.base_score == pytest.approx(want[r.doc_id][2])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    assert (got.score < 0).all() and language_model.score_texts(nothing).count() == 0


def test_score_of_one_state_by_hand(docs):
    """With one state the model is its emissions, which follow from the counts."""
    got = language_model.score_texts(docs, vocabulary=10_000, states=1, rounds=2).toPandas()
    train = [words(t, True) for i, t, *_ in ROWS if zlib.crc32(str(i).encode()) % 10]
    counts, ends, a = Counter(w for ws in train for w in ws), len(train), language_model.ALPHA
    n = counts.total() + ends
    whole = n + 2 * a
    emit = {w: (c + 20 * c / whole) / (n + 20) for w, c in counts.items()}
    other, end = 20 * a / whole / (n + 20), (ends + 20 * (ends + a) / whole) / (n + 20)
    want = {i: sum(math.log10(emit.get(w, other)) for w in words(t, True)) + math.log10(end) for i, t, *_ in ROWS}
    assert all(r.score == pytest.approx(want[r.doc_id], rel=1e-9) for r in got.itertuples())


def test_forward_recursion_is_exact():
    r = np.random.default_rng(1)
    s = language_model.States(np.array([0.4, 0.6]), np.array([[0.7, 0.3], [0.2, 0.8]]), r.dirichlet(np.ones(5), 2).T)
    for seq in ([0], [1, 3, 4], [2, 2, 0, 4, 1]):
        a = s.start * s.emit[seq[0]]
        for x in seq[1:]:
            a = (a @ s.move) * s.emit[x]
        assert language_model.log_likelihoods([np.array(seq), np.array([1])], s)[0] == pytest.approx(math.log10(a.sum()))
        table = language_model.expected_counts([np.array(seq)], s)
        assert table[:5].sum() == pytest.approx(len(seq)) and table[5:7].sum() == pytest.approx(len(seq) - 1)


def test_toxicity(spark, nothing):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        ws = r.choices(VOCABULARY, k=40)
        if bad:
            ws[r.randrange(40)] = r.choice(["Vilest!", "vilestish,", "(vilestly)"])
        rows.append((i, " ".join(ws)))
        if i < 240:
            labels.append((i, int(i % 3 > 0), int(bad)))
    rows += [(300, None), (301, ""), (302, "vilest vilestly")]
    labels += [(5, None, None), (None, 1, 1)]
    table, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(table, marks)
    got = {x["doc_id"]: x["p_toxic"] >= 0.5 for x in toxicity.score_toxicity(table, chain).collect()}
    assert all(got[i] == (i % 4 == 0) for i in range(240, 300)) and got[302] and not got[300] and not got[301]
    # every probability by hand: words, and the earlier category's probability
    for x in toxicity.score_toxicity(table, chain).collect():
        found = [chain.place[f] for f in toxicity.text_features((dict(rows)[x["doc_id"]] or "").encode()) if f in chain.place]
        p = []
        for k in range(2):
            z = chain.intercept[k] + sum(chain.weights[f, k] for f in found) + sum(chain.earlier[k, j] * p[j] for j in range(k))
            p.append(1 / (1 + math.exp(-z)))
        assert [x["p_quality"], x["p_toxic"]] == pytest.approx(p)
    assert chain.earlier[1, 0] != 0
    # rows that share an id are one labelled document
    many = spark.createDataFrame([(7, "vilest")] * 50 + [(8, "fine")], "doc_id long, text string")
    assert toxicity.labelled_sample(many, spark.createDataFrame([(7, 0, 1)], "doc_id long, quality int, toxic int"), ["quality", "toxic"], 1).count() == 1
    kept = toxicity.drop_toxic(table.withColumn("p_toxic", table["doc_id"]), chain)
    assert kept.columns == ["doc_id", "text", "p_toxic"] and {x["doc_id"] for x in kept.collect()} == {i for i, t in got.items() if not t}
    assert toxicity.score_toxicity(nothing, toxicity.fit_chain(nothing, marks.limit(0))).count() == 0


def test_decontamination(spark, docs, nothing):
    r = random.Random(3)
    items = [(i, " ".join(f"q{r.randrange(500)}" for _ in range(25))) for i in range(20)] + [(20, None), (21, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    changed = items[4][1].split()
    changed[3], changed[10] = "other", "words"
    added = [(100, f"{ROWS[1][1]} {items[2][1]} {ROWS[2][1]}"), (101, f"{ROWS[7][1]} " + " and ".join([" ".join(changed[:12]), " ".join(changed[12:])])), (102, items[5][1][: len(items[5][1]) // 3])]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(added, "doc_id long, text string"))
    assert sorted((x["doc_id"], x["item_id"]) for x in decontamination.leaks(table, benchmark).collect()) == [(100, 2), (101, 4)]
    assert decontamination.drop_leaks(table, benchmark).count() == table.count() - 2
    assert decontamination.leaks(nothing, benchmark).count() == 0 and decontamination.leaks(table, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("variants", [1, 7])
def test_paraphrases_are_found(spark, variants):
    r = random.Random(variants)
    items = [(i, " ".join(f"q{r.randrange(900)}{'x' * r.randrange(6)}" for _ in range(r.choice([25, 40, 130])))) for i in range(30)]
    rows, want = [(i, " ".join(r.choices(VOCABULARY, k=120))) for i in range(150)], set()
    for i, t in items:
        for _ in range(variants):
            changed = [r.choice(VOCABULARY) if r.random() < 0.2 else w for w in t.split()]
            rows.append((len(rows), " ".join(r.choices(VOCABULARY, k=60) + changed + r.choices(VOCABULARY, k=60))))
            want.add((len(rows) - 1, i))
    got = {tuple(x)[:2] for x in decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_fit_of_leaks_sees_every_passage(spark, monkeypatch):
    r = random.Random(9)
    rows = [(i if i % 9 else None, " ".join(r.choices(VOCABULARY, k=r.choice([0, 5, 48, 49, 200])))) for i in range(120)] + [(500, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    terms = sorted({w.encode().lower() for w in VOCABULARY} - {VOCABULARY[0].encode()})[::2]
    idf = np.linspace(0.5, 2.0, len(terms))
    place = {t: i for i, t in enumerate(terms)}
    dense = []
    for _, t in rows:
        for p in decontamination.passages_of(decontamination.terms_of((t or "").encode())):
            x = np.zeros(len(terms))
            for w in p:
                if w in place:
                    x[place[w]] += idf[place[w]]
            dense.append(x / (np.linalg.norm(x) or 1.0))
    want = np.array(dense).T @ np.array(dense)
    # with very many sums each passage is alone in its own, so the product is exact
    monkeypatch.setattr(decontamination, "SKETCH", 1 << 40)
    monkeypatch.setattr(decontamination, "HELD_SUMS", 50)
    got = np.zeros_like(want)
    for s in decontamination.passage_sums(table, terms, idf).collect():
        x = np.zeros(len(terms))
        x[np.frombuffer(s["terms"], np.int32)] = np.frombuffer(s["parts"], np.float32)
        got += np.outer(x, x)
    assert np.abs(got - want).max() < 1e-4


def test_blocks_of_items_find_the_same(spark, docs, monkeypatch):
    r = random.Random(6)
    items = [(i, " ".join(f"q{r.randrange(300)}" for _ in range(30))) for i in range(12)] + [(3, "another text of item three with words of its own")]
    rows = [(i, f"{ROWS[i][1]} {t} {ROWS[7][1]}") for i, t in items]
    table, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontamination.leaks(table, benchmark).collect()))
    assert {x[:2] for x in whole} >= {(i, i) for i, _ in items}
    monkeypatch.setattr(decontamination, "BLOCK_PASSAGES", 3)
    monkeypatch.setattr(decontamination, "PASS_BLOCKS", 2)
    assert sorted(map(tuple, decontamination.leaks(table, benchmark).collect())) == whole
    assert decontamination.drop_leaks(table.withColumn("share", table["doc_id"]), benchmark).count() == 0


def test_items_in_many_documents(spark):
    r = random.Random(4)
    items = [(i, " ".join(f"q{r.randrange(500)}" for _ in range(25))) for i in range(5)] + [(5, "of the and w1x w2x the of")]
    rows = [(i, " ".join(r.choices(VOCABULARY, k=60))) for i in range(80)]
    rows = [(i, f"{t} {items[0][1]} {t[::-1]}" if i % 2 else f"{t} of the and w1x w2x the of" if i % 4 else t) for i, t in rows]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontamination.leaks(table, benchmark).collect()}
    assert got == {(i, 0) for i in range(1, 80, 2)} | {(i, 5) for i in range(2, 80, 4)}
    assert {x["doc_id"] for x in decontamination.drop_leaks(table, benchmark).collect()} == set(range(0, 80, 4))


def test_space_holds_every_passage():
    idf, space = np.ones(6), np.eye(6)[:, :2]
    space = decontamination.completed(space, [np.array([0, 1]), np.array([4, 5, 5]), np.array([4, 5])], idf)
    assert space.shape == (6, 3) and np.allclose(space.T @ space, np.eye(3))


def test_common_subsequence():
    assert decontamination.common_subsequence(list("abcde"), list("xaxcxe")) == 3
    assert decontamination.common_subsequence(list("ab"), []) == 0


def bm25(rows, query, k):
    bags = [(i, Counter(words(t, True))) for i, t, *_ in rows]
    n, average = len(bags), sum(b.total() for _, b in bags) / len(bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for i, b in bags:
        s = sum(q * math.log((n - df[w] + 0.5) / (df[w] + 0.5) + 1) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / average)) for w, q in sorted(query.items()) if w in b)
        if round(s, 6) > 0:
            out.append((-round(s, 6), i))
    return [(i, -s) for s, i in sorted(out)[:k]]


def test_search(spark, docs, nothing):
    asked = [(1, ROWS[6][1]), (2, ROWS[68][1]), (3, None), (4, "w3x w3x W9X unseen"), (5, "unseen")]
    got = defaultdict(list)
    for x in search.top_hits(docs, spark.createDataFrame(asked, "doc_id long, text string"), 5).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["doc_id"], x["score"]))
    for q, t in asked:
        want = bm25(ROWS, Counter(words(t, True)), 5)
        assert [i for i, _ in got[q]] == [i for i, _ in want] and [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=2e-6)
    assert search.top_hits(nothing, docs).count() == 0


def test_chat(spark):
    talk = [("user", "hi"), ("assistant", "yes?"), ("user", "bye"), (None, None)]
    rows = [(c, k, r, t, 9) for c, n in ((1, 2), (2, 3), (3, 4), (4, 4), (5, 1)) for k, (r, t) in enumerate(talk[:n])]
    rows += [(6, 0, "user", "other", 9), (6, 0, "user", "other", 9), (None, None, "user", "lost", 9), (7, 0, "user", "hi", 9), (7, 1, "user", "yes?", 9)]
    rows += [(8, k, "user", f"t{k}", 9) for k in range(600)] + [(9, k, "user", f"t{k}", 9) for k in range(300)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int")
    got = {(r["conv_id"], r["part"]): r for r in chat.collapse_and_render(table).collect()}
    assert set(got) == {(3, 0), (6, 0), (None, 0), (7, 0), (8, 0), (8, 1), (8, 2)}
    assert got[3, 0]["n_copies"] == 2 and got[8, 2]["n_turns"] == 600
    line = lambda r, t: f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n"
    assert got[3, 0]["rendered"] == "".join(line(*x) for x in talk)
    assert "".join(got[8, p]["rendered"] for p in range(3)) == "".join(line("user", f"t{k}") for k in range(600))
    assert chat.collapse_and_render(table.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.sql))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    result = con.execute(queries.sql[name])
    columns = [d[0] for d in result.description]
    got = queries.queries[name](spark, sf_dir)
    plain = lambda x: str(float(x)) if isinstance(x, (int, float)) else str(x)
    assert sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in got.collect()) == sorted(
        tuple(plain(v) for _, v in sorted(zip(columns, r))) for r in result.fetchall()
    )


def test_native_plans(spark, sf_dir):
    for name in ("op1_collapsed_chats", "op10_source_mix"):
        plan = queries.queries[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline(spark, sf_dir):
    docs = corpus_pipeline.documents(spark, sf_dir)
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "stage")
        assert 0 < docs.count() <= before
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
    assert docs.select("doc_id").distinct().count() == docs.count()


def test_index_is_held_shard_by_shard(spark, monkeypatch):
    """A row group of the stored index is one shard, so a scan holds one; hits count for a block of queries as terms do."""
    import glob
    import random

    import pyarrow.parquet as pq

    from vereda.llm import search

    draw = random.Random(3)
    texts = [" ".join(f"{draw.getrandbits(64):016x}" for _ in range(40_000)) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(search, "SHARD_BYTES", 1 << 20)
    index = search.index_shards(docs)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert sum(m.num_rows for m in files) == 5 and all(m.row_group(i).num_rows == 1 for m in files for i in range(m.num_row_groups))
    asked = spark.range(400).selectExpr("id as no", "array('a') as terms").localCheckpoint()
    monkeypatch.setattr(search, "QUERY_BYTES", 100_000)
    assert len(search.query_blocks(asked)) == 5
    found = search.top_hits(docs.union(docs.limit(0)), docs.where("doc_id = 2"), 2).collect()
    assert [(r["query_id"], r["rank"], r["doc_id"]) for r in found] == [(2, 1, 2)]
