"""Quality rules, tokenizer alignment and conversation repair against straightforward versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from vereda.llm import alignment, quality, repair

AWKWARD = [
    (100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "a\x00b \x1c c\x85d"), (105, "naïve façade ünter 日本語 テキスト😀"),
    (106, "x" * 9000), (107, "w " * 20_000), (None, "words without an id " * 8), (None, "words without an id " * 8), (108, "a\n\na\nb\n a\na"),
]


def prose(seed, n):
    r = random.Random(seed)
    parts = ["ing", "the", "er", "on", "st", "re", "an", "and"]
    return " ".join("".join(r.choices(parts, k=r.randint(1, 3))) for _ in range(n))


def corpus():
    r = random.Random(4)
    rows = [(i, prose(i, r.choice([25, 60, 120])) + ".") for i in range(40)]
    rows += [(50, " ".join(f"!!{w.upper()}$$" for w in prose(50, 60).split())), (51, rows[3][1]), (51, rows[3][1]), (52, f"{prose(9, 30)}\n" * 3)]
    return rows + AWKWARD


ROWS = corpus()
SCHEMA = "doc_id long, text string, lang string, kept boolean, n_words int, row long, pair string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i is None else ["en", "de"][i % 7 == 0], True, 1, 2, "p") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# -- quality rules


def base(text):
    b = (text or "").encode()
    words = b.split()
    lines = [x for x in b.split(b"\n") if x.split()]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {k for v in windows.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    chars = sum(len(w.decode()) for w in words)
    marks = sum(c in "#*$%&|<>" for c in (text or ""))
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), chars, marks, dup, len(repeated)


def kneser_ney(texts, order):
    """Chen and Goodman's interpolated model over tuples, term by term."""
    sequences = [[0] * (order - 1) + [int(quality.CLASSES[b]) for b in t] + [0] for t in texts]
    counts = {order: Counter(tuple(s[i : i + order]) for s in sequences for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        raised, types = Counter(), Counter()
        for g, n in counts[k + 1].items():
            raised[g[1:]] += n
            types[g[1:]] += 1
        counts[k] = Counter({g: raised[g] if k > 1 and g[0] == 0 else types[g] for g in types})
    discount, after = {}, {}
    for k, table in counts.items():
        n = [sum(c == j for c in table.values()) for j in (1, 2, 3, 4)]
        d = [0.5, 1.0, 1.5]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.05 * j), 0.95 * j) for j in (1, 2, 3)]
        discount[k] = d
        after[k] = defaultdict(list)
        for g, c in table.items():
            after[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if not k:
            return 1 / 64
        seen = after[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        cut = lambda c: discount[k][min(c, 3) - 1]
        c = counts[k].get(g, 0)
        return (max(c - cut(c), 0) if c else 0) / sum(seen) + sum(map(cut, seen)) / sum(seen) * p(g[1:])

    return lambda t: sum(math.log10(p(tuple(s[i : i + order]))) for s in [[0] * (order - 1) + [int(quality.CLASSES[b]) for b in t] + [0]] for i in range(len(s) - order + 1))


def test_quality_against_brute_force(docs):
    got = quality.judge(docs).collect()
    assert len(got) == len(ROWS)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    plain = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(plain((r["doc_id"], *(r[n] for n in names))) for r in got) == sorted(plain((i, *base(t))) for i, t in ROWS)
    score = kneser_ney([(t or "").encode() for _, t in ROWS], 4)
    texts = defaultdict(list)
    for i, t in ROWS:
        texts[i].append(t)
    for r in got:
        t = texts[r["doc_id"]][0]
        b = (t or "").encode()
        if len(b) < 3000:
            assert r["log_ppl"] == pytest.approx(-score(b) / (len(b) + 1), abs=1e-9)
        failed = base(t)[0] < 20 or 100 * base(t)[4] > 30 * base(t)[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["lower"] <= r["log_ppl"] <= r["upper"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept >= set(range(40)) | {51} and 50 not in kept and 107 not in kept


def test_unseen_grams_back_off(docs):
    model = quality.fit(docs.where("doc_id < 10"), 3)
    score = kneser_ney([t.encode() for i, t in ROWS if i is not None and i < 10], 3)
    for t in (b"the\xc3\xa9 QQ~~ 12", b"", b"ingthe on"):
        assert model.log10(quality.grams([t], 3)[0]).sum() == pytest.approx(score(t))
    # every context's probabilities add up to 1 over all symbols
    for context in (0, 21 << 6 | 9, 63 << 6 | 62):
        codes = (np.arange(64) | context << 6).astype(np.uint32)
        assert (10 ** model.log10(codes)).sum() == pytest.approx(1.0)


def test_bands_follow_medians(spark):
    r = random.Random(1)
    rows = [(x, 0.7 + r.gauss(0, 0.01), False) for x in ["a"] * 400 + [None] * 300] + [("b", 0.9, False), ("a", 5.0, True)]
    got = {x["lang"]: x for x in quality.bands(spark.createDataFrame(rows, "lang string, log_ppl double, base_failed boolean")).collect()}
    for lang in ("a", None):
        v = np.array([x[1] for x in rows if x[0] == lang and not x[2]])
        spread = 1.4826 * np.median(np.abs(v - np.median(v)))
        assert got[lang]["lower"] == pytest.approx(np.median(v) - 6 * spread, abs=0.012)
        assert got[lang]["upper"] == pytest.approx(np.median(v) + 6 * spread, abs=0.012)
    # a language with one document is mostly judged as all are
    assert got["b"]["lower"] < 0.7 < got["b"]["upper"] < 0.9


def test_quality_without_rows_or_language(spark, docs):
    assert quality.judge(docs.limit(0)).count() == 0
    assert quality.judge(docs.select("doc_id", "text")).where("kept").count() > 30


# -- tokenizer alignment


def overlaps(rows):
    a, b = alignment.ByteLevel(alignment.default_path(alignment.TOKENIZER_A)), alignment.Pieces(alignment.default_path(alignment.TOKENIZER_B))
    found, held = [], Counter()
    for i, t in rows:
        sides, want = [], (" " + (t or "")).encode()
        for side, ids in ((a, a.tokenizer.encode(" " + (t or ""), add_special_tokens=False).ids), (b, b.model.encode(t or ""))):
            ends, at = [], 0
            for x in ids:
                at += len(side.bytes[x])
                ends.append(at)
            sides.append((ids, ends, b"".join(side.bytes[x] for x in ids)))
        (ia, ea, sa), (ib, eb, sb) = sides
        if not t or sa != want or sb != want:
            found.append((i, 0, 0, 0, [], ""))
            continue
        links = [(x, y) for x, s, e in zip(ia, [0, *ea], ea) for y, u, v in zip(ib, [0, *eb], eb) if u < e and s < v]
        groups, p, q = [], 0, 0
        for m in sorted({*ea} & {*eb}):
            u, v = ea.index(m) + 1, eb.index(m) + 1
            groups.append(",".join(map(str, ia[p:u])) + "|" + ",".join(map(str, ib[q:v])))
            p, q = u, v
        found.append((i, len(ia), len(ib), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.update(set(links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(i, x, y, g, len(k), sum(held[p] == most[p[0]] for p in k), sum(held[p] for p in k), h) for i, x, y, g, k, h in found]


TEXTS = [(i, t[:400] if t else t) for i, t in ROWS] + [
    (200, "  two  spaces \n\n and\tmore "), (201, "a▁b"), (202, "<|endoftext|> </s> <s> <0x41> <unk>"), (203, "don't STOP'S 1234 ...!?"), (204, "a  b　 c\x1c d"), (205, " "),
]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most_pairs", [10**6, 0])
def test_alignment_against_brute_force(spark, most_pairs):
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in TEXTS], "doc_id long, text string, n_a int, row int").repartition(3)
    got = [tuple(r[c] for c in COLUMNS) for r in alignment.align(table, most_pairs=most_pairs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(overlaps(TEXTS), key=key)
    assert alignment.align(table.limit(0), most_pairs=most_pairs).count() == 0


def test_words_of_long_texts_and_of_no_utf8():
    a = alignment.Aligner(alignment.default_path(alignment.TOKENIZER_A), alignment.default_path(alignment.TOKENIZER_B))
    long = prose(3, 30_000)
    got = a.align([long.encode(), b"a \xff b", None])
    assert got[0][0] == len(a.a.tokenizer.tokenizer.encode(" " + long, add_special_tokens=False).ids)
    assert got[0][1] == len(a.b.tokenizer.model.encode(long)) and got[0][2] <= got[0][0]
    assert got[1][:5] == got[2][:5] == (0, 0, 0, 0, 0) and got[1][5] == ""
    before, alignment.REMEMBERED = alignment.REMEMBERED, 10
    try:
        assert a.align([long.encode()])[0] == got[0]
    finally:
        alignment.REMEMBERED = before


@pytest.mark.parametrize("seed", range(5))
def test_galloping_search(seed):
    r = np.random.default_rng(seed)
    among = np.unique(r.integers(0, 5000, 700))
    wanted = np.sort(r.integers(0, among[-1] + 1, 300))
    low, high = np.zeros(300, np.int64), np.full(300, len(among) - 1)
    for hint in (low, high, r.integers(0, len(among), 300)):
        assert (alignment.gallop(wanted, among, low, high, hint) == np.searchsorted(among, wanted)).all()


def test_pairs_pack():
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 31, 500)).astype(np.uint32)
    times = np.arange(len(codes), dtype=np.uint32)
    got = alignment.unpacked(len(codes), alignment.packed(codes), alignment.pa.compress(times, codec="zstd", asbytes=True))
    assert (got[0] == codes).all() and (got[1] == times).all()


# -- conversation repair


def damaged(rows):
    out = []
    for c, k, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if k is None else k}".encode()) % 20
        role = "user" if fault == 4 else role
        text = "" if fault == 1 else text.replace(".", "").replace("!", "").replace("?", "") if fault == 2 else text
        out += [(c, k, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def tried(rows, most_inserts=2):
    """All edit strings of one conversation, up to ``most_inserts`` in a row; the best one."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\f\r")
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for letters in product("DKR", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and x != "D" for x, f in zip(letters, faults)):
            continue
        for gaps in product(range(most_inserts + 1), repeat=len(rows) + 1):
            edits = "".join("I" * g + x for g, x in zip(gaps, [*letters, ""]))
            cost = 5 * sum(gaps) + sum({"D": 2, "K": 0, "R": 1}[x] + 5 * (x != "D" and f == "truncated") for x, f in zip(letters, faults))
            if best is not None and (cost, edits) >= best[:2]:
                continue
            lines, state, left = [], "", iter(rows)
            for x in edits:
                row = next(left) if x != "I" else None
                if x == "D":
                    continue
                other = "assistant" if state == "u" else "user"
                role = row[2] if x == "K" else other
                initial = role[:1]
                if not (initial == "s" and state == "" or initial == other[0]):
                    break
                state = initial
                lines.append(f"{role}:{row[3] if row else ''}")
            else:
                if state in ("", "a"):
                    best = (cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    counts = Counter(faults)
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, *best)


def conversations():
    r = random.Random(8)
    rows = []
    for c in range(40):
        n = r.randint(1, 4)
        for k in range(n):
            role = r.choice(["user", "assistant", "system", "tool", None, ""])
            text = r.choice(["Yes.", "No!", "open", "", " \t", None, "Why? "])
            rows.append((c if c else None, r.choice([k, k, k + 2, None]), role, text))
    dropped = next(c for c in range(500, 600) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "gone.")], dropped


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("block", [repair.BLOCK, 2])
def test_repair_against_all_edits(spark, block):
    rows, dropped = conversations()
    table = spark.createDataFrame([(*x, 1, "k") for x in rows], "conv_id long, turn long, role string, text string, block int, key string").repartition(3)
    got = {r["key"]: tuple(r[n] for n in NAMES) for r in repair.repair(repair.damage(table), block).collect()}
    by = defaultdict(list)
    for x in damaged(rows):
        by[x[0]].append(x)
    assert set(got) == {None if c is None else str(c) for c, *_ in rows}
    assert got[str(dropped)] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for c, own in by.items():
        own.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
        if len(own) <= 5:
            assert got[None if c is None else str(c)] == tried(own), (c, own)
    assert repair.repair(repair.damage(table.limit(0))).count() == 0


def test_long_conversations_spill(spark):
    r = random.Random(3)
    rows = [(1, k, r.choice(["user", "assistant", "system"]), f"{r.choice('abc')}{k % 50 if r.random() < 0.3 else k}{r.choice(['.', '.', ''])}") for k in range(3000)]
    rows += [(2, k, "user", "") for k in range(700)]
    table = repair.prepared(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = sorted(map(tuple, repair.repair(table).collect()))
    found = repair.stream(repair.secondary_sorted(table), 64)
    assert found.where("links IS NOT NULL").count() > 50
    spilled = repair.repair(table, 64)
    assert sorted(map(tuple, spilled.collect())) == whole and whole[1][7] == "D" * 700
    assert sum(x != "I" for x in whole[0][7]) == 3000
    # the rows that the audit leaves give the digest
    left = repair.repaired_rows(table, spilled).where("key = '1'").orderBy("position").collect()
    assert [x["position"] for x in left] == list(range(len(left)))
    assert hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in left).encode()).hexdigest() == whole[0][8]
