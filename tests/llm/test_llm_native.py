"""Mixing, URL filter and secret ledger, the registered queries against SQL, and the pipeline."""

import collections
import hashlib
import math
import random
import re

import duckdb
import pytest

import corpus_pipeline
from corpus import documents, empty, rows_of, sentence
from vitals.llm import mixing, secret_ledger, simhash, url_filter
from vitals.llm.queries import LLM_QUERIES, LLM_SQL

NATIVE = {"op2_mixing", "op3_url_filter", "op10_secret_ledger"}


@pytest.mark.parametrize("key", sorted(LLM_SQL))
def test_query_agrees_with_sql(spark, sf_dir, key):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    frame = LLM_QUERIES[key](spark, sf_dir)
    relation = duck.sql(LLM_SQL[key])
    order = sorted(frame.columns)
    assert order == sorted(relation.columns)
    at = [relation.columns.index(c) for c in order]
    wanted = sorted((str(tuple(row[i] for i in at)) for row in relation.fetchall()))
    assert sorted(str(tuple(r[c] for c in order)) for r in frame.collect()) == wanted


@pytest.mark.parametrize("key", sorted(NATIVE))
def test_native_queries_run_no_python(spark, sf_dir, key):
    plan = LLM_QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- mixing ----------------------------------------------------------------------------------------


def brute_targets(sizes, weights, budget=1.5, most=2.0):
    """Share by weight, hold those above their limit, share the excess again."""
    left, targets, open_ = budget * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = share[i]
            break
        for i in over:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ -= over
    return targets


def test_targets(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = [rng.choice((0, 1, 5, 50, 1000, 20000)) for _ in range(rng.randrange(1, 12))]
        names = [None if i == len(sizes) - 1 and i else f"s{i:02d}" for i in range(len(sizes))]
        frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in rows_of(mixing.targets(frame))}
        wanted = brute_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))])
        assert all(math.isclose(got[n], w, rel_tol=1e-9, abs_tol=1e-6) for n, w in zip(names, wanted)), (sizes, got, wanted)


def test_mix(spark):
    docs = documents(spark)
    got = rows_of(mixing.mix(docs))
    assert len(got) == docs.count()
    source = collections.defaultdict(set)
    for d in rows_of(docs):
        source[d["doc_id"]].add(d["source"])
    taken, longest = collections.Counter(), collections.Counter()
    for g in got:
        assert g["taken"] in (0, g["size"], 2 * g["size"]) and len(g["positions"]) * g["size"] == g["taken"]
        assert all(0 <= p <= 1 for p in g["positions"])
        (name,) = source[g["doc_id"]]
        taken[name] += g["taken"]
        longest[name] = max(longest[name], g["size"])
    for g in got:
        (name,) = source[g["doc_id"]]
        assert abs(taken[name] - g["target"]) <= longest[name]
    again = rows_of(mixing.mix(docs))
    key = lambda g: (str(g["doc_id"]), g["size"], g["taken"], tuple(g["positions"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert rows_of(mixing.mix(empty(spark))) == [] and rows_of(mixing.curriculum(empty(spark))) == []


def test_curriculum_follows_the_schedules(spark):
    """The first source falls from weight 4 to 2, the second rises from 0.5 to 1.5."""
    rng = random.Random(6)
    rows = [(i, sentence(rng, 10), "en", ("a", "b", "c")[i % 3]) for i in range(3000)]
    docs = documents(spark, rows)
    order = [r["source"] for r in rows_of(mixing.curriculum(docs))]
    early, late = collections.Counter(order[: len(order) // 10]), collections.Counter(order[-len(order) // 10 :])
    assert early["a"] > 1.5 * late["a"] and late["b"] > 1.5 * early["b"]
    shares = collections.Counter(order)
    # Of 4500 parts a asks for 2250, its limit is 2000; the excess goes to b and c as 1 to 2.
    assert [round(shares[s] / 1000, 1) for s in "abc"] == [2.0, 0.8, 1.7]
    moments = [p for g in rows_of(mixing.mix(docs)) for p in g["positions"]]
    assert min(moments) < 0.01 and max(moments) > 0.99


# --- URL filter ------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http://a.org", "HTTP://WWW.A.Org:80/x/index.html?utm_source=q&b=2&a=1#f",
    "https://a.org/x?a=1&b=2", "http://x.example.org/es/1", "http://example.org/en/12", "http://notexample.org/en/1",
    "http://b.com/fr/", "http://b.com/de/1?u=http://c.org/", "http://com/de/", "x://y.com?/fr/", "http://é.ORG/ß#://q",
    "http://b.net/k", "http://b.net/k/", "http://b.net/k?ref=1", "http://b.net/k2", "http://b.net/k", "a\nb://c.net/d",
]
RULES = [
    url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


def pages(spark, urls=URLS):
    rows = [(i, u, "html", True) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, host string, listed boolean").repartition(3)


def brute_judge(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    verdict = best.verdict if best else "block" if listed else "allow"
    return host, path, best.host + best.path if best else None, verdict


def test_judged_urls(spark):
    listed = pages(spark, ["https://www.b.net/k/index.htm?gclid=7", "http://b.net/k/", None, "junk"])
    got = rows_of(url_filter.judge(pages(spark), listed, RULES))
    on_list = {i for i, u in enumerate(URLS) if u in ("http://b.net/k", "http://b.net/k/", "http://b.net/k?ref=1")}
    assert sorted((g["page_id"], g["host"], g["path"], g["rule"], g["verdict"]) for g in got) == [
        (i, *brute_judge(u, i in on_list)) for i, u in enumerate(URLS)
    ]
    assert {g["page_id"] for g in got if g["listed"]} == on_list


def test_false_positives_are_removed(spark):
    """One block for thousands of urls passes nearly everything; the join must still tell."""
    urls = [f"http://h{i % 50}.net/{i}" for i in range(4000)]
    wanted = pages(spark, urls[:2000])
    filter_rows = url_filter.bloom_filter(wanted.select(url_filter.canonical(wanted.url).alias("canonical")), 1)
    assert filter_rows.count() == 1 and bin(filter_rows.first()["bits"] & (2**64 - 1)).count("1") > 60
    limit, url_filter.MAX_BLOCKS = url_filter.MAX_BLOCKS, 1
    try:
        got = rows_of(url_filter.judge(pages(spark, urls), wanted, RULES))
    finally:
        url_filter.MAX_BLOCKS = limit
    assert {g["page_id"] for g in got if g["listed"]} == set(range(2000))


def test_empty_tables_and_lists(spark):
    assert rows_of(url_filter.judge(pages(spark).limit(0), pages(spark), RULES)) == []
    got = rows_of(url_filter.judge(pages(spark), pages(spark).limit(0), RULES))
    assert len(got) == len(URLS) and not any(g["listed"] for g in got)


# --- secrets ---------------------------------------------------------------------------------------

SECRETS = [
    'x token = "abc123def" y', "PASSWORD:hunter2!", "secret=token: abcdefgh", "api_key='" + "0f" * 14 + "' é token=abcdef",
    "AKIA" + "A1" * 8, "AKIAAKIA" + "Z9" * 7, "AKIA" + "A" * 15, "a" * 23 + " " + "b" * 24, "日本 passwd  :  '日本",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9, None, "", "token=abcdef" * 50, "token=abc\ntoken=abcdefg",
    "Token\"=\"AKIA" + "0" * 16 + '" ' + "deadbeef" * 4,
]


def brute_spans(text):
    text = text or ""
    kinds = [
        (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24),
    ]
    found = [
        (m.start(), k, m.end())
        for k, (pattern, group, least) in enumerate(kinds) for m in re.finditer(pattern, text) if len(m[group]) >= least
    ]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def versions(spark, texts, first=0):
    return documents(spark, [(first + i, t, "en", "s") for i, t in enumerate(texts)])


def test_base_spans(spark, tmp_path):
    frame = versions(spark, SECRETS)
    got = {g["doc_id"]: g for g in rows_of(secret_ledger.digest_spans(secret_ledger.scan(frame, f"{tmp_path}/l")))}
    for i, text in enumerate(SECRETS):
        wanted = brute_spans(text)
        assert got[i]["base_sha256"] == hashlib.sha256(wanted.encode()).hexdigest(), (text, got[i]["spans"], wanted)
        assert set(filter(None, wanted.split(","))) <= set(got[i]["spans"].split(","))
    assert got[9]["spans"].startswith("private_key:0:") and "github:0:40" in got[10]["spans"]


def test_only_unseen_blobs_and_rules_are_scanned(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    scanned = lambda: spark.read.parquet(ledger).count()
    secret_ledger.scan(versions(spark, SECRETS[:5]), ledger)
    assert scanned() == 5
    # An older path of a known blob, a new blob twice, and known ones: one blob is new.
    later = versions(spark, [SECRETS[0], "secret: swordfish", "secret: swordfish", *SECRETS[:5]], 100)
    got = rows_of(secret_ledger.digest_spans(secret_ledger.scan(later, ledger)))
    assert scanned() == 6
    assert {g["doc_id"] for g in got if g["spans"] == "assign:0:17"} == {101, 102}
    assert next(g["spans"] for g in got if g["doc_id"] == 100) == next(g["spans"] for g in got if g["doc_id"] == 103)
    # A new version of one rule scans all blobs again, for this rule only.
    hexes = secret_ledger.SecretRule("hex", r"[0-9a-f]{12,}", version=2)
    rules = [*secret_ledger.BASE_RULES[:2], hexes]
    found = rows_of(secret_ledger.scan(later, ledger, rules=rules))
    assert scanned() == 12
    assert {tuple(r["rules"]) for r in rows_of(spark.read.parquet(ledger))[-6:]} | {("hex@2",)} >= {("hex@2",)}
    assert all(f["rule"] != "hex@1" for g in found for f in g["findings"])
    assert secret_ledger.scan(empty(spark), ledger).count() == 0 and scanned() == 12


def test_secrets_of_edge_rows(spark, tmp_path):
    docs = documents(spark)
    got = rows_of(secret_ledger.digest_spans(secret_ledger.scan(docs, f"{tmp_path}/l")))
    wanted = sorted((str(d["doc_id"]), hashlib.sha256(brute_spans(d["text"]).encode()).hexdigest()) for d in rows_of(docs))
    assert sorted((str(g["doc_id"]), g["base_sha256"]) for g in got) == wanted


# --- pipeline --------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept, against plain Python."""
    docs = documents(spark).drop("kept", "size", "id", "key", "position")
    rng = random.Random(12)
    more = [(500 + i, "\n".join(sentence(rng, 12) for _ in range(6)), "en", f"s{i % 4}") for i in range(80)]
    more += [(700 + i, more[i][1].replace(" ", "\n", 1), "en", "hot") for i in range(10)]
    more += [(800 + i, more[i][1] + "\nAnd sing.", "en", "hot") for i in range(10)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, "")
    assert known.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in rows_of(known)}
    assert all(r[0] in texts for r in more) and not {1, 4, 7} & set(texts)  # null, empty and blank texts go
    single = stages["exact_dedup"](spark, known, "")
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]) for r in rows_of(single)]
    assert len(normal) == len(set(normal)) and set(normal) == {re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in texts.values()}
    left = rows_of(single)
    distinct = rows_of(stages["simhash"](spark, single, ""))
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) & (2**64 - 1) for r in left if r["doc_id"] is not None}
    parent = {k: k for k in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    parent[a] = parent[b] = min(parent[a], parent[b])
        if all(parent[parent[k]] == parent[k] for k in parent):
            break
    assert {r["doc_id"] for r in distinct if r["doc_id"] is not None} == set(parent.values())
    frame = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in distinct], docs.schema)
    mixed = rows_of(stages["mixing"](spark, frame, ""))
    times = collections.Counter(r["doc_id"] for r in mixed)
    positions = collections.Counter((g["doc_id"], p) for g in rows_of(mixing.mix(frame)) for p in g["positions"])
    assert collections.Counter((r["doc_id"], r["training_position"]) for r in mixed) == positions
    encoded = rows_of(stages["bpe"](spark, stages["mixing"](spark, frame, ""), ""))
    assert collections.Counter((e["doc_id"], e["training_position"]) for e in encoded) == positions
    assert all(len(e["ids"]) == e["n_tokens"] for e in encoded)
    assert collections.Counter(e["doc_id"] for e in encoded) == times
    by_id = {r["doc_id"]: r["text"] for r in mixed}
    assert all(e["decoded_sha256"] == hashlib.sha256(by_id[e["doc_id"]].encode()).hexdigest() for e in encoded)


def test_rows_that_share_a_key_follow_their_own_decisions(spark):
    rng = random.Random(3)
    text = lambda: "\n".join(sentence(rng, 14) for _ in range(5))
    x, y, z, q = text(), text(), text(), text()
    junk = " \t\n"
    rows = [
        (3, y, "en", "a"), (5, x, "en", "a"), (5, y, "en", "a"), (6, z, "en", "a"), (6, q, "en", "b"), (6, q, "en", "b"),
        (None, z, "en", "a"), (7, junk, "en", "a"), (7, text(), "en", "a"), (None, junk, "en", "a"), (None, text(), "en", "b"),
    ]
    rows += [(100 + i, text(), "en", "ab"[i % 2]) for i in range(60)]
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(spark, rows).drop("kept", "size", "id", "key", "position")
    count = lambda frame: collections.Counter((r["doc_id"], r["text"]) for r in rows_of(frame))
    given = collections.Counter(r[:2] for r in rows)
    known = collections.Counter({r: n for r, n in given.items() if r[1] != junk})
    assert count(stages["language_id"](spark, docs, "")) == known
    # y goes with 5 but x stays, q once, and z without a key goes.
    good = docs.filter(docs.text != junk)
    left = {r: 1 for r in known if r not in ((5, y), (None, z))}
    assert count(stages["simhash"](spark, good, "")) == left
    size_of = lambda t: len(t.split())
    wanted = collections.Counter()
    for g in rows_of(mixing.mix(good)):
        wanted[g["doc_id"], g["size"]] += len(g["positions"])
    got = collections.Counter()
    for (key, t), n in count(stages["mixing"](spark, good, "")).items():
        got[key, size_of(t)] += n
    assert +got == +wanted


@pytest.mark.parametrize("dotted", [False, True])
def test_stages_keep_columns_of_any_name(spark, dotted):
    """Names that operators use for their own columns, and one with a dot."""
    docs = documents(spark)
    docs = docs.withColumn("a.b", docs.size).withColumn("training_position", docs.size) if dotted else docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert set(out.columns) == set(docs.columns) | ({"training_position"} if name == "mixing" else set()), name
        assert out.count() > 0 and {r["kept"] for r in out.select("kept").collect()} == {1}
    assert {"doc_id", "ids"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, "").columns)


def test_mix_takes_rows_without_key(spark):
    rng = random.Random(4)
    rows = [(i if i % 2 else None, sentence(rng, 6), "en", "ab"[i % 3 == 0]) for i in range(40)]
    rows += [rows[0], rows[1]]
    docs = documents(spark, rows)
    taken = sum(g["taken"] for g in rows_of(mixing.mix(docs)))
    copies = rows_of(mixing.curriculum(docs))
    assert sum(len(r["text"].split()) for r in copies) == taken and any(r["doc_id"] is None for r in copies)
    order = [r["training_position"] for r in copies]
    assert order == sorted(order) and 0 <= order[0] and order[-1] <= 1


def test_whole_pipeline_against_plain_python(spark, tmp_path):
    """run() on a folder; what the first stage keeps is told by its texts, all else follows in plain Python."""
    rng = random.Random(21)
    text = lambda: "\n".join(sentence(rng, 14) for _ in range(5))
    rows = [(i, text(), "en", f"s{i % 3}") for i in range(90)]
    rows += [(100 + i, rows[i][1], "en", "s1") for i in range(12)]  # copies
    rows += [(200 + i, rows[i][1].replace(" ", "\t", 1), "en", "s2") for i in range(20, 30)]  # copies but for white space
    rows += [(300 + i, rows[i][1] + " And sing.", "en", "s2") for i in range(40, 44)]  # near copies
    rows += [(400, None, "en", "s0"), (401, "", "en", "s1"), (402, " \t", None, None), (None, text(), "en", "s1"), (5, text(), "en", "s0")]
    documents(spark, rows).select("doc_id", "text", "lang", "source").write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(corpus_pipeline.run(spark, str(tmp_path)))

    kept, seen = [], set()
    for row in sorted((r for r in rows if (r[1] or "").strip(" \t\n")), key=lambda r: (r[0] is None, r[0] or 0)):
        normal = re.sub(r"[\x20\x09-\x0D]+", " ", row[1])
        if normal not in seen:
            seen.add(normal)
            kept.append(row)
    prints = [simhash.fingerprint(r[1]) & (2**64 - 1) for r in kept]
    group = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    kept = [r for i, r in enumerate(kept) if group[i] == i]

    words = lambda t: len(t.split())
    sources = sorted({r[3] for r in kept})
    size = {s: sum(words(r[1]) for r in kept if r[3] == s) for s in sources}
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sources)}
    ends = {s: ((4.0, 2.0), (0.5, 1.5), (2.0, 2.0))[i % 3] for i, s in enumerate(sources)}
    target, budget, open_ = {}, 1.5 * sum(size.values()), set(sources)
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else {s: level * weight[s] for s in open_}
        open_ = open_ - full if full else set()
    wanted = []
    for s in sources:
        line = sorted((r for r in kept if r[3] == s), key=lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1]}".encode()).hexdigest())
        a, b = ends[s]
        for turn in range(2):
            at = turn * size[s]
            for r in line:
                middle = at + words(r[1]) / 2
                at += words(r[1])
                if middle <= target[s]:
                    asked = middle / target[s] * (a + b) / 2
                    bend = (b - a) / 2
                    moment = asked / a if not bend else (math.sqrt(a * a + 4 * bend * asked) - a) / (2 * bend)
                    wanted.append((str(r[0]), round(moment, 9), hashlib.sha256(r[1].encode()).hexdigest()))
    assert sorted((str(g["doc_id"]), round(g["training_position"], 9), g["decoded_sha256"]) for g in got) == sorted(wanted)
    ids = {g["ids_sha256"]: g["ids"] for g in got}
    assert all(hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in v)).hexdigest() == k for k, v in ids.items())
