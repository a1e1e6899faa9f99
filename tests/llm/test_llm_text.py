"""Quality rules, language identification, language-model scores, repeats and BPE against brute force."""

import collections
import hashlib
import json
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from corpus import documents, empty, rows_of, sentence
from vitals.llm import bpe, exchange, language, lexicon, lm_scoring, prints, quality_lines, repeats
from vitals.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality ---------------------------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def test_quality_base_rules(spark):
    docs = rows_of(documents(spark))
    got = rows_of(quality_lines.clean(documents(spark)))
    key = lambda d: json.dumps(d, default=str, sort_keys=True)
    names = list(brute_quality(""))
    wanted = [{"doc_id": d["doc_id"]} | brute_quality(d["text"]) for d in docs]
    assert sorted(key({n: g[n] for n in ["doc_id", *names]}) for g in got) == sorted(map(key, wanted))
    assert not any(g["kept"] and g["base_failed"] for g in got)
    assert rows_of(quality_lines.clean(empty(spark))) == []


def test_quality_lines_first():
    rng = random.Random(1)
    body = [sentence(rng, 15) for _ in range(8)]
    menu = "Home | News | Sport | Contact | Login"
    judged = quality_lines.judge("\n".join([menu, *body, "All rights reserved.", menu]), quality_lines.LineRules())
    assert judged[6] is True and judged[10] == "\n".join(body)
    assert judged[8] == 3  # two menus and the notice
    many = "\n".join(f"Item {i} | A{i} | B{i} | C{i} | D{i}" for i in range(40))
    assert quality_lines.judge(many + "\n" + body[0], quality_lines.LineRules())[6] is False
    spam = "\n".join(" ".join(f"{w}$$$ %%%" for w in line.split()) + "." for line in body)
    assert quality_lines.judge(spam, quality_lines.LineRules())[6] is False


# --- language --------------------------------------------------------------------------------------

_LANGUAGES = {
    "en": "the of and to in that with for was this which from have not are they".split(),
    "de": "der die und das nicht eine mit für auf sich dem auch über zwischen groß".split(),
}


def multilingual(seed=11, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        truth = "de" if i % 3 == 0 else "en"
        text = " ".join(rng.choice(_LANGUAGES[truth]) for _ in range(rng.randrange(20, 60)))
        # One declaration in ten is wrong.
        declared = truth if rng.random() > 0.1 else ("en" if truth == "de" else "de")
        rows.append((i, text, declared, f"{truth}{i % 5}.site{i % 2}.{'de' if truth == 'de' else 'com'}", truth))
    return rows


def test_language_held_out_accuracy(spark):
    rows = multilingual()
    docs = documents(spark, [r[:4] for r in rows])
    got = {g["doc_id"]: g for g in rows_of(language.identify(docs, languages=("de", "en")))}
    right = sum(got[r[0]]["language"] == r[4] for r in rows)
    assert right >= 0.99 * len(rows)  # better than the declarations
    assert not any(g["rejected"] for g in got.values())


def test_language_weak_text_follows_host_and_junk_is_rejected(spark):
    rows = [r[:4] for r in multilingual()] + [
        (1000, "Hm", None, "de0.site0.de"), (1001, "Hm", None, "en1.site1.com"), (1002, "", "en", "en1.site1.com"),
        (1003, None, "en", None), (1004, "█▓\u0001~~@@^^``" * 60, None, "new.org"),
    ]
    got = {g["doc_id"]: g for g in rows_of(language.identify(documents(spark, rows), languages=("de", "en")))}
    assert (got[1000]["language"], got[1001]["language"]) == ("de", "en")
    assert [got[i]["rejected"] for i in (1000, 1001, 1002, 1003, 1004)] == [False, False, True, True, True]
    kept = language.keep_identified(documents(spark, rows), languages=("de", "en"))
    assert kept.columns == documents(spark, rows).columns
    assert {k["doc_id"] for k in rows_of(kept)} == {r[0] for r in rows} - {1002, 1003, 1004}


def test_language_of_edge_rows(spark):
    got = rows_of(language.identify(documents(spark)))
    assert len(got) == documents(spark).count()
    assert rows_of(language.identify(empty(spark))) == []


def fused(rows, languages, rules=language.FusionRules()):
    """Plain Python fusion of (id, text, declared, host); trigram models of all declared rows, as of small tables."""
    names = [*languages, language.UNKNOWN]
    fold = lambda t: bytes(language._FOLD[b] for b in (t or "").encode())
    bins = lambda d: [((a * 31 + b) * 1031 + c) * 2654435761 % 2**32 >> 16 for a, b, c in zip(d, d[1:], d[2:])]
    counts = {n: collections.Counter() for n in languages}
    for _, text, declared, _ in rows:
        if text is not None and (declared or "").lower() in counts:
            counts[declared.lower()].update(bins(fold(text)))
    sizes = {n: c.total() + 0.05 * 65536 for n, c in counts.items()}
    seen = []
    for key, text, declared, host in rows:
        data = fold(text)
        own = bins(data)
        logs = [sum(math.log((counts[n][b] + 0.05) / sizes[n]) for b in own) for n in languages] + [-math.log(65536) * len(own)]
        filled = sum(b != 32 for b in data)
        likely = names[logs.index(max(logs))] if filled > 2 else language.UNKNOWN
        host = host or ""
        parent = ".".join(host.split(".")[-2:])
        seen.append((key, logs, likely, filled, (declared or "").lower(), host.split(".")[-1] if "." in host else "", host, parent))
    told = [s for s in seen if s[3] > 2]
    n_of = collections.Counter(s[2] for s in told)
    top = {n: (n_of[n] + 1) / (len(told) + len(names)) for n in names}
    result = []
    for key, logs, likely, filled, declared, suffix, host, parent in seen:
        evidence = []
        for n, log in zip(names, logs):
            total = rules.text_weight * log
            for place, value in ((4, declared), (5, suffix)):
                among = [s[2] for s in told if s[place] == value]
                if value and among:
                    share = rules.table_smoothing * len(among) / max(len(told), 1)
                    total += math.log((among.count(n) + share) / (n_of[n] + rules.table_smoothing))
            mine = [s[2] for s in told if s[6] == host]
            others = [s[2] for s in told if s[7] == parent and s[6] != host]
            k = rules.prior_strength
            up = (others.count(n) + k * top[n]) / (len(others) + k)
            total += math.log((mine.count(n) + k * up) / (len(mine) + k) if mine else top[n])
            evidence.append(total)
        best = max(evidence)
        share = 1 / sum(math.exp(e - best) for e in evidence)
        found = names[evidence.index(best)]
        rejected = not filled or found == language.UNKNOWN or share < rules.min_confidence
        result.append((key, language.UNKNOWN if rejected else found, round(share, 4), likely, declared or None, rejected))
    return sorted(result, key=repr)


def found_by(frame):
    return sorted([(*r[:2], round(r[2], 4), *r[3:]) for r in map(tuple, frame.collect())], key=repr)


def test_pages_are_told_by_address_and_markup(spark, tmp_path):
    page = '<!DOCTYPE html><html{}><head><script>var t="</p>der die";</script></head><body><nav>the</nav><p>{}</p></body></html>'
    rows, wanted = [], []
    for i, text, declared, host, _ in multilingual(n=120):
        rows.append((i, f"https://{host.upper()}:8080/a?b=//c", page.format(f' class="x" lang="{declared}-XX"' if i % 4 else "", text)))
        wanted.append((i, language.page_text(rows[-1][2]), declared if i % 4 else None, host))
    for i, url, host in ((900, "http://new.other.de/", "new.other.de"), (901, "http://a.new.com", "a.new.com"), (902, None, None)):
        rows.append((i, url, page.format("", "Hm &amp;")))
        wanted.append((i, language.page_text(rows[-1][2]), None, host))
    assert language.page_text(rows[-1][2]).split() == ["Hm", "&"]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = LLM_QUERIES["op1_page_language"](spark, str(tmp_path))
    assert found_by(got) == fused(wanted, language.LANGUAGES)
    language_of = {r["page_id"]: r["language"] for r in rows_of(got)}
    assert (language_of[900], language_of[901]) == ("de", "en")  # hosts never seen, told by suffix alone


def test_sources_are_smoothed_towards_the_table(spark):
    """A host without dots is its own parent; its counts must not be smoothed with themselves."""
    rows = [(i, text, declared, f"src{i % 7}") for i, text, declared, _, _ in multilingual(n=90)]
    rows += [(900 + i, text, None, f"src{i}") for i, text in enumerate(("Hm", "of it", "auf", "", None))]
    assert found_by(language.identify(documents(spark, rows))) == fused(rows, language.LANGUAGES)


# --- language model --------------------------------------------------------------------------------


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def test_lm_base_and_model(spark):
    docs = documents(spark)
    rows = rows_of(docs)
    fold = lambda d: zlib.crc32(("" if d["doc_id"] is None else str(d["doc_id"])).encode()) % 7
    counts = collections.Counter(t for d in rows if fold(d) != 2 for t in tokens(d["text"]))
    n, v = sum(counts.values()), len(counts)
    got = rows_of(lm_scoring.score(docs, chunk_bytes=20_000, bucket_bytes=50_000))
    wanted = collections.Counter(
        (
            str(d["doc_id"]), fold(d) == 2, len(tokens(d["text"])), sum(counts[t] > 0 for t in tokens(d["text"])), n,
            round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(d["text"])), 5),
        )
        for d in rows
    )
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    assert wanted == collections.Counter(
        tuple(str(g[k]) if k == "doc_id" else round(g[k], 5) if k == "base_score" else g[k] for k in names) for g in got
    )
    again = rows_of(lm_scoring.score(docs))
    assert sorted(round(g["score"], 6) for g in got) == sorted(round(g["score"], 6) for g in again)
    assert all(g["score"] < 0 for g in got)


def doubled(size):
    """Two words that sums of bytes times powers modulo 2**64 do not tell apart, whatever the bytes are."""
    one, other = "a", "b"
    while len(one) < size:
        one, other = one + other, other + one
    return one, other


@pytest.mark.parametrize("size", [1024, 2048, 8192])
def test_words_built_by_doubling_are_not_confused(spark, size):
    one, other = doubled(size)
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    kept = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 not in (2, 3))
    got = {g["doc_id"]: g for g in rows_of(lm_scoring.score(documents(spark, [(kept, one, "en", "s"), (held, other, "en", "s")])))}
    assert (got[held]["n_known"], got[kept]["n_known"]) == (1, 2)
    assert got[held]["base_score"] == pytest.approx(math.log10(1 / 5) + math.log10(2 / 5))


def brute_scores(rows, deleted=3, held_out=2):
    """The model in plain Python: counts, octaves of the context's count, weights by EM, and the score."""
    fold = lambda key: zlib.crc32(("" if key is None else str(key)).encode()) % 7
    words, pairs, words_left, pairs_left = (collections.Counter() for _ in range(4))
    held = collections.Counter()
    for d in rows:
        own = tokens(d["text"])
        own_pairs = list(zip([None, *own[:-1]], own))
        if fold(d["doc_id"]) != held_out:
            words.update(own)
            pairs.update(own_pairs)
            if fold(d["doc_id"]) == deleted:
                held.update(own_pairs)
            else:
                words_left.update(own)
                pairs_left.update(own_pairs)
    # An end, None, is the last token of a text and also what precedes its first word.
    total, left, known = sum(words.values()), sum(words_left.values()), len(words)
    level = lambda n: n.bit_length()

    def parts(counts, both, n, u, w):
        seen = counts[u]
        return level(seen), (both[u, w] / seen if seen else 0.0, counts[w] / n if n else 0.0, 1 / (known + 1))

    weights = {i: [1 / 3] * 3 for i in range(65)} | {0: [0.0, 0.5, 0.5]}
    told = [(*parts(words_left, pairs_left, left, u, w), n) for (u, w), n in held.items()]
    moved = 1.0 if left else 0.0
    if not left:
        weights = {i: [0.0, 0.0, 1.0] for i in range(65)}
    while moved >= 1e-4:
        mass = collections.defaultdict(lambda: [0.0] * 3)
        for at, estimates, n in told:
            share = [x * y for x, y in zip(weights[at], estimates)]
            for i in range(3):
                mass[at][i] += n * share[i] / sum(share)
        found = {at: [x / sum(m) for x in m] for at, m in mass.items()}
        moved = max((abs(x - y) for at in found for x, y in zip(found[at], weights[at])), default=0.0)
        for at in range(65):
            weights[at] = found.get(at, weights[at - 1] if at > 1 else weights[at])
    scores = []
    for d in rows:
        own, score = tokens(d["text"]), 0.0
        for u, w in zip([None, *own[:-1]], own):
            at, estimates = parts(words, pairs, total, u, w)
            score += math.log10(sum(x * y for x, y in zip(weights[at], estimates)))
        scores.append((str(d["doc_id"]), score))
    return sorted(scores)


def test_lm_score_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, rng.randrange(1, 60)).lower().replace(".", ""), "en", "s") for i in range(150)]
    rows += [(150, None, "en", "s"), (151, "", "en", "s"), (None, "the quick unheard", "en", "s"), rows[4]]
    docs = documents(spark, rows)
    got = sorted((str(g["doc_id"]), g["score"]) for g in rows_of(lm_scoring.score(docs, chunk_bytes=2_000, bucket_bytes=5_000)))
    wanted = brute_scores(rows_of(docs))
    assert [k for k, _ in got] == [k for k, _ in wanted]
    assert [s for _, s in got] == pytest.approx([s for _, s in wanted], rel=1e-4)


def test_lm_is_a_distribution_and_beats_words_alone(spark):
    """Texts in which each word tells the next; held-out texts must be likelier than under word counts."""
    rng = random.Random(4)
    cycle = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(300):
        at = rng.randrange(30)
        text = []
        for _ in range(40):
            text.append(cycle[at])
            at = (at + 1) % 30 if rng.random() < 0.9 else rng.randrange(30)
        rows.append((i, " ".join(text), "en", "s"))
    got = [g for g in rows_of(lm_scoring.score(documents(spark, rows))) if g["held_out"]]
    per_token = lambda c: sum(g[c] for g in got) / sum(g["n_tokens"] for g in got)
    assert per_token("score") > per_token("base_score") + 0.7
    # The best possible: 0.9 + 0.1 / 30 for the next word, 0.1 / 30 for any other.
    assert per_token("score") < 0.9 * math.log10(0.9) * 40 / 41


def test_lm_without_training_documents(spark):
    held = [(i, "a b c", "en", "s") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = rows_of(lm_scoring.score(documents(spark, held)))
    assert {(g["n_known"], g["train_tokens"], g["base_score"], g["score"]) for g in got} == {(0, 0, 0.0, 0.0)}
    assert rows_of(lm_scoring.score(empty(spark))) == []


def test_weights_follow_the_likelihood(spark):
    """Contexts whose pairs always hold get weight on pairs, others on words."""
    row = lambda level, pair, word: {
        "octave": exchange.pack(np.full(50, level, np.uint8)), "pair": exchange.pack(np.full(50, pair, np.float32)),
        "word": exchange.pack(np.full(50, word, np.float32)), "n": exchange.pack(np.full(50, 2, np.uint32)),
    }
    frame = spark.createDataFrame(
        [row(5, 0.9, 1.0), row(9, 0.0, 300.0)], "octave binary, pair binary, word binary, n binary"
    )
    weights = lm_scoring.learn_weights(frame, 1000, 100, rounds=60)
    assert weights[5, 0] > 0.95 and weights[9, 1] > 0.95
    assert np.allclose(weights.sum(axis=1), 1) and np.array_equal(weights[7], weights[5])


def test_weights_settle_by_default(spark):
    """Pairs a third likelier than words win slowly; twelve rounds leave them some 0.92."""
    part = lambda value, kind: exchange.pack(np.full(50, value, kind))
    frame = spark.createDataFrame(
        [(part(5, np.uint8), part(0.013, np.float32), part(10, np.float32), part(2, np.uint32))],
        "octave binary, pair binary, word binary, n binary",
    )
    assert lm_scoring.learn_weights(frame, 1000, 100)[5, 0] > 0.995
    with pytest.warns(RuntimeWarning, match="after 12 rounds"):
        assert lm_scoring.learn_weights(frame, 1000, 100, rounds=12)[5, 0] < 0.95


# --- repeats ---------------------------------------------------------------------------------------


def brute_repeats(rows, length=50):
    result, earlier = [], set()
    order = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    at = 0
    while at < len(order):
        same = [r for r in order if r["doc_id"] == order[at]["doc_id"]]
        own = set()
        for r in same:
            data = (r["text"] or "").encode()
            gone = np.zeros(len(data), bool)
            for i in range(len(data) - length + 1):
                own.add(data[i : i + length])
                if data[i : i + length] in earlier:
                    gone[i : i + length] = True
            kept = bytes(b for b, g in zip(data, gone) if not g)
            spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
            result.append((str(r["doc_id"]), len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        earlier |= own
        at += len(same)
    return sorted(result)


SIZES = [{}, {"chunk_bytes": 3000, "bucket_bytes": 9000, "hot_chunks": 2}]


@pytest.mark.parametrize("sizes", SIZES)
def test_repeats_of_edge_rows(spark, sizes):
    rows = [r for r in rows_of(documents(spark)) if len(r["text"] or "") < 50_000]
    docs = documents(spark, [(r["doc_id"], r["text"], "en", "s") for r in rows])
    got = rows_of(repeats.remove_repeats(docs, **sizes))
    assert sorted(tuple(str(g[c]) if c == "doc_id" else g[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for g in got) == brute_repeats(rows)
    assert all(hashlib.sha256(bytes(g["kept"])).hexdigest() == g["kept_sha256"] for g in got)
    assert rows_of(repeats.remove_repeats(empty(spark))) == []


@pytest.mark.parametrize("size", [64, 1024, 4096])
def test_strings_built_by_doubling_are_not_repeats(spark, size):
    one, other = doubled(size)
    rows = [(1, one), (2, other), (3, "-" + one), (4, "-" + other)]
    got = rows_of(repeats.remove_repeats(documents(spark, [(k, t, "en", "s") for k, t in rows]), with_text=False))
    wanted = brute_repeats([{"doc_id": k, "text": t} for k, t in rows])
    assert sorted((str(g["doc_id"]), g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) for g in got) == wanted


def test_fingerprints_are_polynomials_modulo_a_prime():
    rng = np.random.default_rng(2)
    prime, data = (1 << 61) - 1, rng.integers(0, 256, 2_300_000).astype(np.uint8)
    starts = np.sort(np.append(rng.integers(0, 2_000_000, 40), 5))
    ends = starts + rng.integers(0, 200, len(starts))
    ends[0] = 2_200_000  # longer than a stretch of running sums
    for point in (0, 1):
        wanted = []
        for a, z in zip(starts.tolist(), ends.tolist()):
            value = 0
            for byte in reversed(data[a:z].tolist()):
                value = (value * prints._POINTS[point] + byte + 1) % prime
            wanted.append(value + z - a)
        assert prints.prints(data, starts, ends, point).tolist() == prints.mix(np.array(wanted, np.uint64)).tolist()


def repetitive(seed, n=60):
    """Few letters, periodic texts, shared passages of lengths around the limit, cut at all places."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abc") for _ in range(rng.choice((30, 49, 50, 51, 79, 80, 81, 200)))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(4)
            if kind == 0:
                parts.append(rng.choice("ab") * rng.randrange(1, 130))
            elif kind == 1:
                passage = rng.choice(passages)
                cut = rng.randrange(len(passage))
                parts.append(rng.choice((passage, passage[cut:], passage[:cut])))
            elif kind == 2:
                parts.append("".join(rng.choice("abcdé") for _ in range(rng.randrange(60))))
            else:
                parts.append("xyz" * rng.randrange(1, 40))
        rows.append((rng.randrange(40), "".join(parts), "en", "s"))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_of_repetitive_texts(spark, seed):
    rows = repetitive(seed)
    got = rows_of(repeats.remove_repeats(documents(spark, rows), chunk_bytes=700, bucket_bytes=2000, hot_chunks=2))
    wanted = brute_repeats([{"doc_id": r[0], "text": r[1]} for r in rows])
    assert sorted((str(g["doc_id"]), g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) for g in got) == wanted


@pytest.mark.parametrize("period", sorted(repeats.COVERS))
def test_covers(period):
    cover = repeats.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# --- exchange --------------------------------------------------------------------------------------


def test_packing():
    rng = np.random.default_rng(2)
    for kind in ("<u8", "<i8", "<u4", "u1", "<f4"):
        array = rng.integers(0, 200, 1000).astype(kind)
        assert np.array_equal(exchange.unpack(exchange.pack(array), kind), array)
        assert len(exchange.unpack(exchange.pack(array[:0]), kind)) == 0
    keys = np.sort(rng.integers(0, 1 << 64, 1000, np.uint64))
    assert np.array_equal(exchange.unpack_sorted(exchange.pack_sorted(keys), "<u8"), keys)
    parts = list(exchange.split(keys, 7))
    assert [b for b, _ in parts] == sorted({b for b, _ in parts}) and sum(p.stop - p.start for _, p in parts) == 1000


def test_chunks_hold_every_text_once(spark):
    docs = documents(spark)
    for size in (1, 500, 1 << 20):
        chunks = [exchange.Chunk.of(r.asDict()) for r in exchange.chunk_texts(docs, "doc_id", "text", size).collect()]
        held = [
            (str(k), bytes(c.data[a:b]).decode())
            for c in chunks for k, a, b in zip(c.keys, c.offsets[:-1], c.offsets[1:], strict=True)
        ]
        assert sorted(held) == sorted((str(d["doc_id"]), d["text"] or "") for d in rows_of(docs))
        assert len({c.number for c in chunks}) == len(chunks)


def test_tasks_grow_with_the_input(spark):
    """Twice the text gives twice the files of chunks, and so the tasks of every step; no table is left."""
    rng = random.Random(1)
    rows = [(i, sentence(rng, 200), "en", "s") for i in range(800)]
    files = []
    for n in (400, 800):
        docs = documents(spark, rows[:n])
        chunks = exchange.chunk_texts(docs, "doc_id", "text", 1_000, task_bytes=20_000)
        files.append(exchange.task_count(spark, sum(len(r[1]) for r in rows[:n]), 20_000))
        assert len(chunks.inputFiles()) <= files[-1]
        numbers = [r["chunk"] for r in chunks.select("chunk").collect()]
        answers = spark.createDataFrame([(n, 0, b"x") for n in numbers], "chunk bigint, bucket int, answer binary")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        told = exchange.over_chunks(chunks, lambda c, given: iter([{"chunk": c.number}]), "chunk bigint", [answers])
        plan = told._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert f"SelectedBucketsCount: {files[-1]} out of {files[-1]}" in plan
        assert sorted(r["chunk"] for r in told.collect()) == sorted(numbers)
    assert files[1] in (2 * files[0] - 1, 2 * files[0])
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("chunks_")]


# --- BPE -------------------------------------------------------------------------------------------

tokenizers = pytest.importorskip("tokenizers")
needs_vocabulary = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no vocabulary file")


def encoder_of(words):
    vocabulary = bpe.Vocabulary(bpe.VOCABULARY)
    return bpe.Encoder(vocabulary, bpe.build_lexicon(sorted(words), vocabulary))


def check_against_library(texts, words):
    library = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    encoder = encoder_of(words)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ids, bounds = encoder.encode(data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]))
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == wanted
    decoded = [t.decode() for t in bpe._texts(encoder, ids, bounds)]
    assert decoded == [library.decode(w, skip_special_tokens=False) for w in wanted] == texts


@needs_vocabulary
def test_bpe_agrees_with_the_library():
    rng = random.Random(8)
    pieces = [
        "a", "the", " the", "ing", "é", "ß", " ", "  ", "\n", "\r\n", "\t", "　", "\xa0", "'s", "'re", "'", "''", "'ll",
        "12", "½", "٣", "日本", "😀", "<|endoftext|>", "<|endof", "text|>", "...", "$", "S", "́", "\x85", "\x1c",
    ]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(4000)]
    texts += ["", "a" * 5000, "ab" * 3000 + " " * 500, "x'sam don't I'Ve"]
    check_against_library(texts, {w.encode() for t in texts[:300] for w in re.findall(r" ?\w+|\s+|[^\w\s]+", t)})
    check_against_library(texts[:200], set())


@needs_vocabulary
def test_code_points_agree_with_the_library():
    rng = random.Random(9)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check_against_library(["a" + chr(c) + "1" + chr(c) + " " + chr(c) for c in rng.sample(points, 8000)], set())


@needs_vocabulary
def test_bpe_query(spark):
    docs = documents(spark)
    library = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    wanted = sorted((str(d["doc_id"]), library.encode(d["text"] or "", add_special_tokens=False).ids, d["text"] or "") for d in rows_of(docs))
    for words in (1 << 17, 5, 0):
        got = rows_of(bpe.encode(docs, lexicon_words=words))
        assert sorted((str(g["doc_id"]), g["ids"], g["decoded"]) for g in got) == wanted
    hashed = rows_of(bpe.encode_digests(docs))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((str(g["doc_id"]), g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) for g in hashed) == sorted(
        (k, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(t.encode())) for k, ids, t in wanted
    )
    assert rows_of(bpe.encode(empty(spark))) == []


def test_lexicon_is_minimal_and_numbers_words():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))).encode() for _ in range(400)})
    arrays = lexicon.compile_lexicon(words, [[i] * (i % 3) for i in range(len(words))])
    tails = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(arrays["final"]) == len(tails)  # one state per set of endings
    others = [b"abcabca", b"d", b"\xff"]
    data = np.frombuffer(b"".join(words + others), np.uint8)
    ends = np.cumsum([len(w) for w in words + others])
    starts = ends - [len(w) for w in words + others]
    found = lexicon.look_up(arrays, data, starts, ends).tolist()
    assert found == [*range(len(words)), *([-1] * 3)]
    assert lexicon.look_up(lexicon.compile_lexicon([], []), data, starts, ends).tolist() == [-1] * len(found)
