"""Periodic runs, benchmark passages and the prefix trie against brute force."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import documents, empty, rows_of, sentence
from vitals.llm import decontaminate, periodic_runs, prefix_trie
from vitals.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs -----------------------------------------------------------------------------------


def brute_runs(words):
    """(start, length, period), every period and every stretch tried."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            stop = i
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            stretch = words[i : stop + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.append((i, len(stretch), q))
            i = stop + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, letters = rng.randrange(90), rng.choice([1, 2, 2, 3, 5])
    words = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        period, start = rng.randrange(1, max(2, n // 4)), rng.randrange(n)
        for i in range(start + period, n):
            words[i] = words[i - period]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        sizes = np.array([len(t) for t in texts])
        limits = np.concatenate([[0], np.cumsum(sizes)])
        words = np.array([w for t in texts for w in t], np.int64)
        got = periodic_runs.runs_of(words, np.repeat(limits[:-1], sizes), np.repeat(limits[1:], sizes), 6, 4)
        wanted = [(s + limits[k], s + limits[k] + n, q) for k, t in enumerate(texts) for s, n, q in brute_runs(t)]
        assert list(zip(*(g.tolist() for g in got))) == [tuple(map(int, w)) for w in wanted]


def test_wavelet_tree_successors():
    rng = np.random.default_rng(1)
    for size in (1, 63, 64, 65, 500):
        values = rng.integers(0, 100, size)
        tree = periodic_runs.WaveletTree(values, 7)
        low = rng.integers(0, size, 200)
        high = rng.integers(low, size + 1)
        above = rng.integers(0, 100, 200)
        wanted = [min((v for v in values[a:z] if v > x), default=-1) for a, z, x in zip(low, high, above)]
        assert tree.successor(low, high, above).tolist() == wanted


def dropped(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_find_runs_over_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{x}" for x in random_words(rng)), "en", "s") for i in range(60)]
    rows += [(None, "a b " * 9, "en", "s"), (7, "same same\tsame same\nsame same", None, None), (7, None, None, None), (8, "", None, "s")]
    rows += [(9, "x " * 30_000 + "y", "de", "s"), rows[3]]
    frame = documents(spark, rows)
    wanted = []
    for key, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = [(0, 30_000, 1)] if key == 9 and text.endswith("y") and len(words) > 100 else brute_runs(words)
        wanted.append((key, len(words), runs, dropped(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(frame).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert rows_of(periodic_runs.find_runs(empty(spark))) == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(frame, min_exponent=3)


def test_op11_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choices("abcdefgh", k=rng.randrange(0, 60))) for i in range(300)}
    texts[301], texts[302] = None, "\t\n"
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.asDict() for r in LLM_QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    planted = 0
    for key, text in texts.items():
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(key).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        assert got[key] == {
            "doc_id": key, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            "collapsed_sha256": sha(dropped(words, runs)),
        }, key
    assert planted > 10 and sum(r["n_runs"] > 0 for r in got.values()) > 10


# --- benchmark passages ------------------------------------------------------------------------------


def normal(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]


def brute_leaks(text, items):
    words = normal(text)
    plain, hit, found = [w for w, _ in words], set(), set()
    for item, body in items:
        own = [w for w, _ in normal(body)]
        size = min(10, len(own))
        for k in range(len(own) - size + 1) if own else ():
            for i in range(len(plain) - size + 1):
                if plain[i : i + size] == own[k : k + size]:
                    hit |= set(range(i, i + size))
                    found |= {str(item)} if item is not None else set()
    spans = []
    for i in sorted(hit):
        if i - 1 in hit:
            spans[-1][1] = words[i][1][1]
        else:
            spans.append(list(words[i][1]))
    return len(words), len(hit), sorted(found), [tuple(s) for s in spans]


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 60])
def test_benchmark_passages_equal_brute_force(spark, block_words):
    rng = random.Random(3)
    long_word = "Z" * 200
    items = [(i, sentence(rng, rng.randrange(8, 40))) for i in range(12)]
    items += [(12, "Two words"), (13, "ça—va 日本 x"), (14, None), (15, "?!"), (2, items[5][1]), (None, "no id given here at all in this one item"), (3, f"a {long_word} b")]
    items.append((100, sentence(rng, 25) + " " + items[0][1]))
    bodies = [t for _, t in items if t]
    docs = [(i, sentence(rng, 20) + " " + rng.choice(bodies).upper().replace(" ", " - ") + " " + sentence(rng, 9), "en", "s") for i in range(40)]
    docs += [(50, None, None, None), (51, "", None, None), (None, items[1][1] * 3, None, None), (52, "TWO... words two", "en", "s"), docs[0]]
    docs += [(53, f"A {long_word.lower()} b; a {long_word[:-1]}y b", "en", "s"), (54, "ÇA—VA", "en", "s"), (55, "é😀 ça—va 日本 X é", "en", "s")]
    docs += [(56, " ".join([items[0][1]] * 400), "en", "s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_benchmark(documents(spark, docs), benchmark, block_words=block_words)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in found.collect()]
    wanted = [(key, *brute_leaks(text, items)) for key, text, *_ in docs]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert sum(w[2] > 0 for w in wanted) > 30


def test_benchmark_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    clean = rows_of(decontaminate.find_benchmark(documents(spark), none))
    assert len(clean) == documents(spark).count() and not any(r["n_hit"] or r["items"] or r["spans"] for r in clean)
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert rows_of(decontaminate.find_benchmark(empty(spark), some)) == []


# --- prefix trie -------------------------------------------------------------------------------------


def rebuilt(rows):
    said = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in said.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return whole


def brute_trie(whole):
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(ids), len(node), min(members[node[:-1]]) if node else -1, len(ids), children[node], leaves[node], saved[node],
            sha(",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(node))),
        )
        for node, ids in members.items()
    )


def grown(rng, n):
    """Conversations that share beginnings, some whole, some one a beginning of another."""
    rows = []
    for c in [rng.randrange(-150, 700) for _ in range(n)]:
        for turn in range(rng.randrange(1, 12)):
            rows.append((c, turn, ("user", "assistant")[turn % 2], rng.choice("ab") if rng.random() < 0.8 else f"é{c}"))
    kinds = {}
    return [kinds.setdefault((r[0], r[1]), r) for r in rows if (r[0], r[1]) not in kinds]


@pytest.mark.parametrize("chunk, cells", [(prefix_trie.CHUNK, prefix_trie.MOST_CELLS), (3, 64)])
def test_trie_equals_brute_force(spark, chunk, cells):
    """Also with short chunks, and with a sketch so small that it proves next to nothing."""
    rows = grown(random.Random(6), 160)
    rows += [(900, None, None, "first"), (900, 0, "user", None), (None, 1, "user", "nobody's"), (901, 1, "user", "x" * 5000)]
    rows += [(902, t, "user", "long") for t in range(150)] + [(903, t, "user", "long") for t in range(140)]
    columns = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], columns + ", depth int, conv string").repartition(4)
    turns, ids = prefix_trie.share_heads(prefix_trie.number_turns(frame), every=100, most=5, chunk=chunk)
    found = prefix_trie.trie(turns, ids, chunk=chunk, most_cells=cells)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in found.collect())
    assert got == brute_trie(rebuilt(rows))


def test_trie_ties_and_emptiness(spark):
    columns = "conv_id long, turn long, role string, text string"
    # Two turns of one number, one of them given twice, and the same again in another conversation and order.
    rows = [(1, 5, "b", "x"), (1, 5, "a", "y"), (1, 5, "a", "y"), (2, 5, "a", "y"), (2, 5, "b", "x"), (2, 5, "a", "y")]
    turns = prefix_trie.number_turns(spark.createDataFrame(rows, columns))
    nodes = prefix_trie.trie(turns, turns.select("conv").distinct()).orderBy("depth").collect()
    assert [(r.depth, r.n_convs, r.saved_tokens) for r in nodes] == [(0, 2, 3), (1, 2, 3), (2, 2, 2), (3, 2, 1)]
    none = prefix_trie.number_turns(spark.createDataFrame([], columns))
    assert rows_of(prefix_trie.trie(*prefix_trie.share_heads(none, 100, 5))) == []


def test_screening_never_calls_a_shared_prefix_alone(spark):
    rows = spark.range(4000).select(
        F.xxhash64(F.col("id") % 3000).alias("x"), F.xxhash64(F.lit(1), F.col("id") % 3000).alias("y"),
        *[F.lit(1).cast("bigint").alias(c) for c in ("px", "py", "depth")], (F.col("id") % 3000 >= 1000).alias("single"),
    )
    for width in (64, 1 << 13):
        found = prefix_trie.screened(rows, width)
        assert found.filter("alone AND NOT single").count() == 0
    assert found.filter("alone").count() > 1900
