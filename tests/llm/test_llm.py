"""Operators on text against brute force, exact round trips and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from skylattice.llm import chat_format, components, decontamination, exchange, fm_index, language_model, near_dedup, packing, quality_classifier, quality_rules, substring_dedup, text, token_output, tokens, url_filter

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, n_words string, _id string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def documents(spark, texts, ids=None):
    """documents with columns whose names clash with the operators' own."""
    rows = [(i, t, "en", f"src{k % 3}", None if t is None else len(t), "x", "y", "z") for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts))]
    return spark.createDataFrame(rows, DOCS)


def odd_texts(rng, n=60):
    """Random texts with copies, shared passages, nulls, empty and long ones, and odd characters."""
    words = [f"w{k}" for k in range(40)] + ["Été", "THE", "it's", "#1", "x y", "中文", "a|b"]
    say = lambda m: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", " "]) for _ in range(m))
    passage = say(60)
    out = [None, "", " \n ", "one", say(3000), passage]
    while len(out) < n:
        kind = rng.random()
        if kind < 0.3:
            out.append(rng.choice(out))
        elif kind < 0.5:
            out.append(say(rng.randint(0, 40)) + passage + say(rng.randint(0, 40)))
        else:
            out.append(say(rng.randint(1, 120)))
    return out


def ids_for(texts):
    return [None, *range(10, 10 + len(texts) - 1)]


# --- primitives ------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_split_words(seed):
    texts = odd_texts(random.Random(seed))
    w = text.split_words(pa.array(texts))
    flat = w.words.to_pylist()
    assert [flat[a:b] for a, b in zip(w.first, w.first[1:])] == [SPACE_WORDS.findall(t or "") for t in texts]
    w = text.split_words(pa.array(texts), text.NOT_ALNUM, lower=True)
    flat = w.words.to_pylist()
    assert [flat[a:b] for a, b in zip(w.first, w.first[1:])] == [ALNUM_WORDS.findall(lower(t)) for t in texts]


def test_blocks():
    batches = [pa.RecordBatch.from_pydict({"id": list(range(k, k + 5)), "text": ["x" * 30] * 4 + [None]}) for k in range(0, 50, 5)]
    out = list(text.blocks(iter(batches), "text", 100))
    assert [i for b in out for i in b.column(0).to_pylist()] == list(range(50)) and all(b.num_rows < 8 for b in out)


@pytest.mark.parametrize("name,units", [("word_bpe_49k.json", "space"), ("byte_bpe_50k.json", "lead")])
def test_tokens(name, units):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    signs = [*"aAzZ'’sStT  \n\t.!?#1290éÉßœ…— 　", "'s", "'re", " '", " \n", "\n\n", "<|endoftext|>", "́", "İ", "\x01", " ", "½", "中", "\x1c"]
    texts = [None, ""] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    path = tokens.vocabulary_path(name)
    ids, at = tokens.encoder(path, units).encode(pa.array(texts))
    plain = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [[*e.ids, 0] for e in plain]


def test_exchange():
    rng = np.random.default_rng(0)
    for _ in range(20):
        keys = np.unique(rng.integers(0, 2**64, rng.integers(1, 500), dtype=np.uint64))
        counts = rng.integers(0, 1000, len(keys))
        got = [(np.cumsum(exchange.expand(exchange.parts_of(d)[0], np.uint64)), exchange.expand(exchange.parts_of(d)[1], np.uint64)) for _, d in exchange.sends(keys, [counts], 7)]
        assert np.array_equal(np.concatenate([g[0] for g in got]), keys) and np.array_equal(np.concatenate([g[1] for g in got]), counts)


@pytest.mark.parametrize("fan", [64, 3])
def test_totals(spark, tmp_path, monkeypatch, fan):
    monkeypatch.setattr(exchange, "FAN", fan)
    monkeypatch.setattr(exchange, "MERGE_BYTES", 500)
    rng = np.random.default_rng(2)
    sent = [np.unique(rng.integers(0, 400, 150, dtype=np.uint64) * np.uint64(2**55 + 12345)) for _ in range(12)]
    kinds = [[rng.integers(0, 9, len(k)) for _ in range(2)] for k in sent]
    rows = [(f"b{j}", b, bytearray(d)) for j, (k, c) in enumerate(zip(sent, kinds)) for b, d in exchange.sends(k, c, exchange.fan(32))]
    table = spark.createDataFrame(rows, exchange.MESSAGE)
    answer = lambda keys, x, y: ([x.astype(np.uint64), (y % 250).astype(np.uint8)], np.array([len(keys)]).tobytes())
    out = exchange.totals(table, answer, [np.uint64, np.uint8], 32, f"file://{tmp_path}").collect()
    total = [collections.Counter(), collections.Counter()]
    for k, c in zip(sent, kinds):
        for j in range(2):
            for key, n in zip(k.tolist(), c[j].tolist()):
                total[j][key] += n
    assert sum(int(np.frombuffer(r["data"], np.int64)[0]) for r in out if not r["block"]) == len(total[0])
    for j, k in enumerate(sent):
        mine = [r.asDict() for r in out if r["block"] == f"b{j}"]
        assert exchange.reply_array(mine, np.uint64, 0).tolist() == [total[0][x] for x in k.tolist()]
        assert exchange.reply_array(mine, np.uint8, 1).tolist() == [total[1][x] % 250 for x in k.tolist()]


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(100):
        length, v = int(rng.integers(1, 8)), int(rng.integers(1, 5))
        texts = [rng.integers(1, v + 1, rng.integers(length, 30)) for _ in range(rng.integers(1, 10))]
        t = np.concatenate([np.append(x, 0) for x in texts])
        index = fm_index.FMIndex(t)
        order = sorted(range(len(t)), key=lambda k: t[k:].tolist())
        assert index.locate(np.arange(1, len(t) + 1)).tolist() == order
        least = int(rng.integers(1, 3))
        matched, lo, hi = index.matching_statistics(t, length, least)
        text_of = lambda a, b: tuple(t[a : b + 1])
        for e in range(len(t)):
            best = 0
            while best < length and e - best >= 0 and t[e - best] and sum(text_of(p - best, p) == text_of(e - best, e) for p in range(best, len(t))) >= least:
                best += 1
            assert matched[e] == best
            if best == length:
                places = [p - length + 1 for p in range(length - 1, len(t)) if text_of(p - length + 1, p) == text_of(e - length + 1, e)]
                assert sorted(index.locate(np.arange(lo[e], hi[e]))) == places


# --- operators -------------------------------------------------------------------


def test_url_filter(spark, monkeypatch):
    urls = [None, "no scheme", "http://A.Example.NET/en/1", "https://x.example.com/de/?q=1", "ftp://y.org/fr", "ftp://y.org/fr/a#b", "http://net", "http://b.net/", "http://www.z.com/p/?utm_source=a&k=1", "http://z.com/p?k=1#top", "http://z.com/p", "", "http://z.com/p?k=1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("z.com/p?k=1",), (None,), ("z.com/p?k=1",)], "url_key string")
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["listed"]) for r in url_filter.judge(pages, listed, rules).collect()}
    assert got[0] == got[1] == ("", "", None, "allow", False)
    assert got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow", False)
    assert got[3][:4] == ("x.example.com", "/de/", "example.com/de/", "block")
    assert got[4][2] is None and got[5][2:4] == ("org/fr/", "allow") and got[6][2] is None and got[7][2:4] == ("net/", "block")
    assert [k for k in got if got[k][4]] == [8, 9, 12] and len(got) == len(urls)
    empty = url_filter.judge(pages, listed.limit(0), rules)
    assert empty.count() == len(urls) and not empty.where("listed").count()
    assert url_filter.judge(pages.limit(0), listed, rules).count() == 0
    monkeypatch.setattr(url_filter, "EXPRESSION_RULES", 3)  # rules as a table, list by a shuffle
    monkeypatch.setattr(url_filter, "BROADCAST_URLS", 0)
    again = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["listed"]) for r in url_filter.judge(pages, listed, rules).collect()}
    assert again == got
    odd = pages.unionAll(pages.where("page_id in (0, 2, 8)")).unionAll(spark.createDataFrame([(99, "http://a.net/" + "x" * 200_000)], pages.schema))
    odd = odd.withColumns({c: F.lit("clash") for c in ("block", "listed", "host", "rule", "verdict", "url_key")})
    many = url_filter.judge(odd, listed, rules).collect()
    assert len(many) == len(urls) + 4 and all(again[r["page_id"]] == tuple(r)[1:] for r in many if r["page_id"] != 99)
    assert [(r["rule"], len(r["path"])) for r in many if r["page_id"] == 99] == [("net/", 200_001)]


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h.com/"), "id").alias("url_key"))
    pages = spark.range(8000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.com/"), "id").alias("url"))
    got = url_filter.judge(pages, keys, [])
    assert got.where("listed").count() == 5000 and got.where("listed and page_id >= 5000").count() == 0


def test_sum_index():
    lengths = np.array([1, 3, 4, 7, 10, 19])
    index = packing.SumIndex(lengths, 24)
    for total in range(24):
        assert {(total - x, x) for x in index.pairs(total).tolist()} == {(b, a) for a, b in itertools.combinations_with_replacement(lengths.tolist(), 2) if a + b == total}
        assert set(index.thirds(total).tolist()) == {x for t in itertools.combinations_with_replacement(lengths.tolist(), 3) if sum(t) == total for x in t}


@pytest.mark.parametrize("seed", range(3))
def test_packing_plan(seed):
    rng = np.random.default_rng(seed)
    for lengths in (rng.integers(1, 65, 3000), np.repeat([21, 43, 64, 1], [500, 400, 3, 7]), rng.integers(30, 35, 1000), np.clip(rng.lognormal(2.5, 1, 4000).astype(int), 1, 64)):
        counts = collections.Counter(lengths.tolist())
        plan = packing.plan(counts, 64)
        used = collections.Counter()
        for pattern, n in plan:
            assert sum(pattern) <= 64 and n > 0
            for x in pattern:
                used[x] += n
        assert used == counts
    assert sum(n for _, n in packing.plan(collections.Counter(np.clip(rng.lognormal(2, 1, 40_000).astype(int), 1, 64).tolist()), 64)) > 0


def test_packing(spark):
    from tokenizers import Tokenizer

    texts = odd_texts(random.Random(3))
    rows = packing.pack(documents(spark, texts, ids_for(texts)), 128).collect()
    plain = Tokenizer.from_file(tokens.vocabulary_path("word_bpe_49k.json"))
    by_doc = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, t in zip(ids_for(texts), texts):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["length"] for r in parts] == [len(ids[a : a + 128]) for a in range(0, len(ids), 128)]
        for r in parts:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 128
    assert len(by_sequence) <= math.ceil(sum(r["length"] for r in rows) / 128 * 1.05) + 1
    assert packing.pack(documents(spark, [])).count() == 0


def clashing(docs):
    """Every row twice, with columns named like those that the operators make."""
    return docs.unionAll(docs).withColumns({c: F.lit("clash") for c in ("length", "rank", "salt", "score", "start", "piece", "partition", "part", "file", "base", "before", "x", "n", "v", "k")})


def test_packing_of_repeated_rows(spark):
    texts = odd_texts(random.Random(4), 30)
    docs = documents(spark, texts, [None, *[7] * (len(texts) - 1)])
    piece = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    once = collections.Counter(map(piece, packing.pack(docs, 128).collect()))
    rows = packing.pack(clashing(docs), 128).collect()
    assert collections.Counter(map(piece, rows)) == collections.Counter({k: 2 * n for k, n in once.items()})
    at = collections.Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    assert max(at.values()) <= 128


def brute_contamination(texts, items, window):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM_WORDS.findall(lower(t))
        k = min(window, len(w))
        for s in range(len(w) - k + 1) if k else []:
            windows[tuple(w[s : s + k])].add(i)
    sizes = {len(x) for x in windows}
    for t in texts:
        w = ALNUM_WORDS.findall(lower(t))
        hit, found = set(), set()
        for s in range(len(w)):
            for k in sizes:
                x = tuple(w[s : s + k])
                if len(x) == k and x in windows:
                    hit |= set(range(s, s + k))
                    found |= windows[x]
        yield len(w), len(hit), found


@pytest.mark.parametrize("seed", range(40))
def test_contamination_kernel(seed):
    rng = random.Random(seed)
    letters = [chr(97 + k) for k in range(rng.choice([2, 3, 6]))] + ["zz"]
    say = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    texts = [rng.choice([None, "", say(rng.randint(1, 80))]) for _ in range(5)]
    items = [(k, rng.choice([None, say(rng.randint(1, 6)), say(rng.randint(4, 30))])) for k in range(rng.randint(0, 5))]
    part = decontamination.Slice.of([i for i, _ in items], pa.array([t for _, t in items], pa.string()), 4)
    w = text.split_words(pa.array(texts, pa.large_string()), text.NOT_ALNUM, lower=True)
    hit, found = decontamination._hits(w, [part])
    assert list(zip(np.diff(w.first).tolist(), hit.tolist(), found)) == list(brute_contamination(texts, items, 4))


def test_contamination(spark, monkeypatch):
    rng = random.Random(5)
    texts = odd_texts(rng)
    items = [(k, t) for k, t in enumerate([texts[5], "w1 w2", None, "", "never there at all"])] + [(None, "w3 w4 w5")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, texts, ids_for(texts))
    expected = {}
    for i, (n, hit, found) in zip(ids_for(texts), brute_contamination(texts, items, 10)):
        names = sorted(str(x) for x in found if x is not None)
        expected[i] = (n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0)
    for size in (2_000_000, 100):  # one slice, and more than a worker keeps
        monkeypatch.setattr(decontamination, "SLICE_BYTES", size)
        monkeypatch.setattr(decontamination, "KEPT_SLICES", 2)
        got = {r["doc_id"]: tuple(r)[1:] for r in decontamination.contamination(docs, bench.unionAll(bench)).collect()}
        assert got == expected
    twice = decontamination.contamination(docs.unionAll(docs).withColumn("doc_id", F.lit(1).cast("long")), bench).groupBy("n_words", "n_hit", "n_items").count().collect()
    assert collections.Counter({tuple(r)[:3]: r["count"] for r in twice}) == collections.Counter(e[:3] for e in list(expected.values()) * 2)
    kept = decontamination.remove(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, e in expected.items() if not e[4]}
    m = decontamination.longest_matches(docs, bench).where("item_id = 0 and item_start = 0").head()
    assert m["length"] == len(ALNUM_WORDS.findall(lower(texts[5])))
    assert decontamination.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


def components_of(points, most):
    label = list(range(len(points)))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a in range(len(points)):
        for b in range(a):
            if bin(points[a] ^ points[b]).count("1") <= most:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(points))]


def brute_fingerprint(t, size=4):
    w = SPACE_WORDS.findall(lower(t))
    shingles = [" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("levels", [10, 1])
def test_simhash(spark, monkeypatch, levels):
    monkeypatch.setattr(near_dedup, "SHARD", 8)
    monkeypatch.setattr(near_dedup, "MOST_LEVELS", levels)  # 1: all further levels are dealt in rounds, two at a time
    monkeypatch.setattr(near_dedup, "MORE_LEVELS", 2)
    texts = odd_texts(random.Random(7), 90)
    ids = ids_for(texts)
    docs = documents(spark, texts, ids)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in near_dedup.components(docs).collect()}
    points = [brute_fingerprint(t) for t in texts]
    least = components_of(points, 4)  # ids ascend, null first
    assert got == {i: (f"{p:016x}", ids[least[k]]) for k, (i, p) in enumerate(zip(ids, points))}
    assert near_dedup.components(docs.limit(0)).count() == 0
    assert near_dedup.components(docs.unionAll(docs)).count() == 2 * len(texts)


@pytest.mark.parametrize("seed", range(8))
def test_vantage_point_trees(seed):
    rng = np.random.default_rng(seed)
    p = rng.integers(0, 2**63, 700).astype(np.uint64)
    q = p[rng.integers(0, 700, 700)]
    for _ in range(rng.integers(1, 7)):
        q = q ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64))
    p = np.unique(np.concatenate([p, q]))
    most = int(rng.choice([4, 7, 11]))
    near = int(rng.choice([most, 3]))
    links = near_dedup.Links(len(p))
    for k, mask in enumerate(near_dedup.segments(3)):
        levels = int(rng.integers(0, 5))
        tree = near_dedup.build(p[:300], mask, levels, k)
        index, shard, owner = near_dedup.route(p, tree, levels, mask, most // 3)
        for s in np.unique(shard):
            g = index[shard == s]
            found = near_dedup.Search(np.stack([p[g], p[g]], 1), owner[shard == s], mask, most // 3, near, most, earlier=[(0, m) for m in near_dedup.segments(3)[:k]] if near == most else []).run()
            a, b = found.forest()
            links.add(g[a], g[b])
            points = found.open()
            i, j = np.nonzero(np.bitwise_count(p[g][points][:, None] ^ p[g][points][None, :]) <= most)
            links.add(g[points][i], g[points][j])
    whole = near_dedup.Links(len(p))
    i, j = np.nonzero(np.bitwise_count(p[:, None] ^ p[None, :]) <= most)
    whole.add(i, j)
    assert np.array_equal(np.unique(whole.label, return_inverse=True)[1], np.unique(links.label, return_inverse=True)[1])


def test_components(spark, tmp_path):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 50), (50, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), f"file://{tmp_path}/a").collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 130)) and got[200] == got[50] == 50 and len(got) == 41 + 30 + 2
    assert components.components(spark.createDataFrame([], "a long, b long"), f"file://{tmp_path}/b").count() == 0


def test_distinct(spark):
    rng = random.Random(9)
    words = [f"v{k}" for k in range(3000)]
    base = [[rng.choice(words) for _ in range(300)] for _ in range(30)]
    near = []
    for k in range(20):
        w = list(base[k])
        w[100] = "changed"
        if k >= 10:  # far below the similarity
            for j in range(0, 300, 6):
                w[j] = "other"
        near.append(w)
    docs = documents(spark, [" ".join(w) for w in base + near] + [None, "", ""])
    kept = near_dedup.distinct(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(30)) | set(range(40, 50)) | {50}
    assert near_dedup.distinct(docs.limit(0)).count() == 0


def test_distinct_with_repeated_rows_and_shared_ids(spark):
    x, y, z = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    docs = documents(spark, [x, x, x, y, x, z, None, None], [1, 1, 2, 1, None, 3, None, 4])
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in near_dedup.distinct(docs).collect())
    assert got == [(False, 0, ""), (False, 0, x), (True, 1, y), (True, 3, z)]


def test_distinct_counts_each_shingle_once(spark):
    rng = random.Random(21)
    words = [f"v{k}" for k in range(3000)]
    texts = []
    for _ in range(12):
        head, passage = [rng.choice(words) for _ in range(280)], [rng.choice(words) for _ in range(20)]
        texts += [" ".join(head + passage * 2), " ".join(head + passage * 17)]  # one set of shingles
    got = near_dedup.fingerprints(pa.array(texts), 5, wide=True)
    assert (got[::2] == got[1::2]).all()
    assert {r["doc_id"] for r in near_dedup.distinct(documents(spark, texts)).collect()} == set(range(0, 24, 2))


def shingle_sets(texts):
    return [set(h.tolist()) for h in near_dedup.shingle_hashes(pa.array(texts), 5)]


def test_distinct_verifies_close_fingerprints(spark):
    rng = random.Random(22)
    words = [f"v{k}" for k in range(3000)]
    texts = []
    for _ in range(1500):
        w = [rng.choice(words) for _ in range(300)]
        v = list(w)
        for j in rng.sample(range(5, 295, 6), 7 + rng.randrange(3)):
            v[j] = "other"
        texts += [" ".join(w), " ".join(v)]
    sets, fp = shingle_sets(texts), near_dedup.fingerprints(pa.array(texts), 5, wide=True)
    far = [k for k in range(0, 3000, 2) if np.bitwise_count(fp[k, :2] ^ fp[k + 1, :2]).sum() <= 10 and len(sets[k] & sets[k + 1]) < 0.8 * len(sets[k] | sets[k + 1])]
    chosen = [texts[j] for k in far for j in (k, k + 1)]
    assert len(far) > 2 and near_dedup.distinct(documents(spark, chosen)).count() == len(chosen)


def test_distinct_misses_no_pair(spark, monkeypatch):
    rng = random.Random(23)
    words = [f"v{k}" for k in range(3000)]
    line, texts = [rng.choice(words) for _ in range(40)], []
    for k in range(500):
        w = [rng.choice(words) for _ in range(rng.choice([60, 120, 300]))] + line * (k % 5 == 0)
        v = list(w)
        for j in rng.sample(range(5, len(w) - 5, 6), round(len(w) * rng.choice([0.018, 0.02, 0.022, 0.024]))):
            v[j] = "other"
        texts += [" ".join(w), " ".join(v)]
    base = texts[0].split()
    for k in range(40):  # one group of many
        v = list(base)
        for j in rng.sample(range(5, len(v) - 5, 6), max(1, len(v) // 60)):
            v[j] = f"x{k}"
        texts.append(" ".join(v))
    sets = shingle_sets(texts)
    n, least = len(texts), list(range(len(texts)))
    by_shingle = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for h in s:
            by_shingle[h].append(k)
    root = lambda k: k if least[k] == k else root(least[k])
    around = 0
    for i, j in sorted({(x, y) for m in by_shingle.values() for x in m for y in m if x < y}):
        both = len(sets[i] & sets[j])
        if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            around += 10 * both < 8.5 * (len(sets[i]) + len(sets[j]) - both)
            x, y = sorted((root(i), root(j)))
            least[y] = x
    assert around > 100
    assert {r["doc_id"] for r in near_dedup.distinct(documents(spark, texts)).collect()} == {k for k in range(n) if least[k] == k}
    monkeypatch.setattr(near_dedup, "links", lambda *a: spark.createDataFrame([], near_dedup.LINKS))  # the join alone, with large meetings
    assert {r["doc_id"] for r in near_dedup.distinct(documents(spark, texts)).collect()} == {k for k in range(n) if least[k] == k}


def brute_mixture(tokens_of):
    """score(tokens) of a bigram mixture whose weights maximise the likelihood of fold 3 under the counts of the other training folds."""

    def counted(folds):
        uni, bi, context = collections.Counter(), collections.Counter(), collections.Counter()
        for i, t in tokens_of.items():
            if language_model.fold_of(i) in folds:
                uni.update(t)
                for a, b in zip(["<s>", *t], t):
                    bi[a, b] += 1
                    context[a] += 1
        return uni, bi, context

    every, kept = counted({0, 1, 3, 4, 5, 6}), counted({0, 1, 4, 5, 6})
    uniform = 1 / (len(every[0]) + 1)

    def parts(counts, a, b):
        uni, bi, context = counts
        return context[a].bit_length(), (bi[a, b] / max(context[a], 1), uni[b] / max(sum(uni.values()), 1), uniform)

    by_class = collections.defaultdict(list)
    for i, t in tokens_of.items():
        if language_model.fold_of(i) == 3:
            for a, b in zip(["<s>", *t], t):
                k, p = parts(kept, a, b)
                by_class[k].append(p)
    weights = {}
    for k, p in by_class.items():
        p, w = np.array(p), np.full(3, 1 / 3)
        for _ in range(language_model.EM_ROUNDS):
            share = w * p
            w = (share / share.sum(1, keepdims=True)).sum(0) + 1e-3
            w /= w.sum()
        weights[k] = w

    def score(t):
        total = 0.0
        for a, b in zip(["<s>", *t], t):
            k, p = parts(every, a, b)
            w = weights[max((c for c in weights if c <= k), default=min(weights))]
            w = w if every[2][a] else np.array([0, *(w[1:] / w[1:].sum())])
            total += math.log10(w @ p)
        return total

    return score


@pytest.mark.parametrize("fan", [2_048, 2])
def test_language_model(spark, monkeypatch, fan):
    monkeypatch.setattr(exchange, "FAN", fan)  # 2: messages are merged and passed on
    monkeypatch.setattr(exchange, "MERGE_BYTES", 3_000)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(language_model, "EM_ROUNDS", 12)
    monkeypatch.setattr(language_model, "EM_STEP", 0)

    texts = odd_texts(random.Random(11), 120)
    ids = ids_for(texts)
    docs = documents(spark, texts, ids)
    got = {r["doc_id"]: r for r in language_model.score(docs).collect()}
    tokens_of = {i: [*SPACE_WORDS.findall(lower(t)), None] for i, t in zip(ids, texts)}
    counts = collections.Counter()
    for i, t in tokens_of.items():
        if not (language_model.fold_of(i) == 2):
            counts.update(t)
    model = brute_mixture(tokens_of)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens_of.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == ((language_model.fold_of(i) == 2), len(t), sum(counts[x] > 0 for x in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t), rel=1e-9)
        assert r["score"] == pytest.approx(model(t), rel=1e-9)
    assert len(got) == len(texts)
    held = [got[i] for i in ids if got[i]["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert language_model.score(docs.limit(0)).count() == 0
    only_held_out = docs.where(F.col("doc_id").isin([i for i in ids if i is not None and (language_model.fold_of(i) == 2)]))
    assert all(math.isfinite(r["score"]) and r["train_tokens"] == 0 for r in language_model.score(only_held_out).collect())


def test_language_model_of_repeated_rows(spark):
    texts = odd_texts(random.Random(12), 30)
    ids = ids_for(texts)
    got = language_model.score(clashing(documents(spark, texts, ids))).collect()
    counts = collections.Counter()
    tokens_of = {i: [*SPACE_WORDS.findall(lower(t)), None] for i, t in zip(ids, texts)}
    for i, t in tokens_of.items():
        if language_model.fold_of(i) != 2:
            counts.update(t * 2)
    n, v = sum(counts.values()), len(counts)
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter({i: 2 for i in ids})
    for r in got:
        t = tokens_of[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(counts[x] > 0 for x in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in t), rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_quality_classifier(spark):
    rng = random.Random(13)
    good = [" ".join(rng.choice(["the", "cat", "sat", "on", "mats", "with", "joy."]) for _ in range(60)) for _ in range(300)]
    bad = [" | ".join(rng.choice(["BUY", "NOW", "!!!", "$$$"]) for _ in range(60)) for _ in range(100)]
    texts = good + bad + [None, ""]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(k, int(k < 300), 0) for k in range(0, 400, 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_classifier.score(docs, labels).collect()}
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] for k in held)
    assert np.mean([got[k]["predicted"] == int(k < 300) for k in held]) > 0.97
    kept = quality_classifier.keep(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["predicted"]}
    assert quality_classifier.score(docs, labels.limit(0)).where("score = 1").count() == len(texts)
    assert quality_classifier.score(docs.limit(0), labels).count() == 0
    twice = quality_classifier.score(docs.unionAll(docs), labels.unionAll(labels)).collect()
    assert collections.Counter(r["doc_id"] for r in twice) == collections.Counter({k: 2 for k in got})
    assert np.mean([abs(r["score"] - got[r["doc_id"]]["score"]) for r in twice]) < 0.01


@pytest.mark.parametrize("seed", range(3))
def test_least_risk(seed):
    """No small move of the weights has a lower risk, unless it brings the second part below 0."""
    rng = np.random.default_rng(seed)
    n, prior = 4_000, 0.7
    good = rng.random(n) < prior
    x = np.hstack((rng.normal(size=(n, 3)) + good[:, None] * np.array([1.0, 0.5, 0]), np.ones((n, 1))))
    positive = good & (rng.random(n) < 0.3)
    w = quality_classifier.fit(lambda w: quality_classifier.sums_of(x, positive, w), 4, prior)

    def risk(w):
        f = x @ w
        second = np.logaddexp(0, f).mean() - prior * np.logaddexp(0, f[positive]).mean()
        return prior * np.logaddexp(0, -f[positive]).mean() + max(0, second) + 0.5 * quality_classifier.PENALTY * (w[:-1] ** 2).sum(), second

    best, second = risk(w)
    assert second >= 0
    for _ in range(200):
        assert risk(w + rng.normal(size=4) * 0.05)[0] >= best - 1e-4
    assert np.mean((x @ w > 0) == good) > np.mean(good)


def test_quality_classifier_held_out(spark):
    """Held-out accuracy and order on the given table."""
    sf = "/root/testdata/sf0.1"
    read = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    rows = quality_classifier.score(read("documents"), read("labels")).where("held_out").join(read("labels"), "doc_id").select("score", "predicted", "quality").collect()
    s, y = np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows]) == 1
    auc = (s[y][:, None] > s[~y][None]).mean() + 0.5 * (s[y][:, None] == s[~y][None]).mean()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    print("held-out AUC", auc, "accuracy", right, "of", len(rows))
    assert auc > 0.97 and right > 0.95


def brute_rules(t):
    w = SPACE_WORDS.findall(t or "")
    windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = set()
    for k in range(len(w) - 2):
        if windows[tuple(w[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in (t or "").split("\n") if SPACE_WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, monkeypatch):
    texts = odd_texts(random.Random(17)) + ["a b c a b c", "x\nx\n\nx y\n x", "w1 " * 200]
    ids = ids_for(texts)
    docs = documents(spark, texts, ids)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs, max_docs=3).collect()}
    assert len(got) == len(texts)
    holders = collections.defaultdict(set)
    norm = lambda x: " ".join(SPACE_WORDS.findall(x)).translate(str.maketrans(quality_rules.UPPER, quality_rules.LOWER))
    for k, t in enumerate(texts):
        for x in (t or "").split("\n"):
            if SPACE_WORDS.search(x):
                holders[k % 3, norm(x)].add(k)
    for k, (i, t) in enumerate(zip(ids, texts)):
        r = got[i]
        counts = brute_rules(t)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts
        lost = sum(len(SPACE_WORDS.findall(x)) for x in (t or "").split("\n") if SPACE_WORDS.search(x) and len(holders[k % 3, norm(x)]) > 3)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert r["n_boilerplate"] == lost and r["kept"] == (not failed and lost <= 0.5 * counts[0])
        assert r["base_failed"] == failed
    assert quality_rules.judge(docs.limit(0)).count() == 0
    monkeypatch.setattr(quality_rules, "BROADCAST_LINES", 0)
    assert {r["doc_id"]: r for r in quality_rules.judge(docs, max_docs=3).collect()} == got
    cleaned = {r["doc_id"]: r["text"] for r in quality_rules.clean(docs, max_docs=3).collect()}
    assert len(cleaned) == len(texts) and cleaned[ids[3]] == "one"


def test_quality_rules_with_repeated_and_null_ids(spark):
    say = lambda name, n: " ".join(f"{name}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(n))
    lone, common = say("lone", 60), say("common", 30)
    rows = [(1, lone)] * 101 + [(k, f"{say(f'own{chr(97 + k % 26)}{chr(97 + k // 26)}', 70)}\n{common}") for k in range(2, 110)]
    rows += [rows[-1], (None, f"{common}\n{say('few', 25)}")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = {(r["doc_id"], r["n_boilerplate"], r["kept"]) for r in quality_rules.judge(docs).collect()}
    assert got == {(1, 0, True), *((k, 30, True) for k in range(2, 110)), (None, 30, False)}
    texts = {(r["doc_id"], r["text"]) for r in quality_rules.clean(docs).collect()}
    assert (1, lone) in texts and (None, say("few", 25)) in texts and len(texts) == 110


def test_token_output(spark):
    from tokenizers import Tokenizer

    texts = odd_texts(random.Random(19))
    ids = ids_for(texts)
    rng = random.Random(1)
    order = list(zip(ids, texts))
    rng.shuffle(order)
    got = {r["doc_id"]: r for r in token_output.token_output(documents(spark, [t for _, t in order], [i for i, _ in order])).collect()}
    plain, at = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json")), 0
    for i, t in zip(ids, texts):
        e = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(e), zlib.crc32(np.array(e, "<u4").tobytes()))
        at += len(e)
    assert token_output.token_output(documents(spark, [])).count() == 0


def test_token_output_of_repeated_rows(spark):
    texts = odd_texts(random.Random(20), 30)
    docs = documents(spark, texts, [None, *[7] * 10, *range(20, 20 + len(texts) - 11)])
    row = lambda r: (r["doc_id"], r["n_tokens"], r["ids_crc32"])
    once = collections.Counter(map(row, token_output.token_output(docs).collect()))
    rows = sorted(token_output.token_output(clashing(docs)).collect(), key=lambda r: r["start"])
    assert collections.Counter(map(row, rows)) == collections.Counter({k: 2 * n for k, n in once.items()})
    assert [r["start"] for r in rows] == [0, *itertools.accumulate(r["n_tokens"] for r in rows[:-1])]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 20, 32])
def test_bit_packing(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2**bits, 10_001, dtype=np.uint64).astype(np.uint32)
    starts = np.array([0, 0, 5, 4096, 9000, 10_001])
    shard = token_output.Shard(token_output.shard_bytes(np.arange(5), starts, ids, bits, 1000))
    assert np.array_equal(shard.ids(0, len(ids)), ids) and np.array_equal(shard.ids(990, 3010), ids[990:3010])
    assert [shard.document(k).tolist() for k in range(5)] == [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
    assert token_output.width(50_257) == 16 and token_output.width(65_537) == 17 and token_output.width(1) == 1
    if bits < 32 and bits != 16:
        with pytest.raises(ValueError):
            token_output.pack_block(np.array([2**bits], np.uint32), bits)


def test_viterbi_in_chunks():
    rng = np.random.default_rng(0)
    move = np.log(rng.dirichlet(np.ones(chat_format.STATES), chat_format.STATES + 1))
    scores = np.log(rng.random((40, chat_format.STATES)))
    at = lambda *x: np.array(x)
    whole_matrix = chat_format.chunk_matrices(scores, at(0), at(40), move)
    (before, last), = chat_format.borders(list(whole_matrix))
    whole = chat_format.decode_chunks(scores, at(0), at(40), move, at(before), at(last))
    first = np.arange(0, 40, 7)
    length = np.minimum(7, 40 - first)
    ends = chat_format.borders(list(chat_format.chunk_matrices(scores, first, length, move)))
    assert np.array_equal(chat_format.decode_chunks(scores, first, length, move, np.array([e[0] for e in ends]), np.array([e[1] for e in ends])), whole)

    def total(states):
        return move[chat_format.STATES, states[0]] + scores[0, states[0]] + sum(move[a, b] + scores[k, b] for k, (a, b) in enumerate(zip(states, states[1:]), 1))

    best = total(whole)
    for _ in range(300):
        other = whole.copy()
        other[rng.integers(0, 40)] = rng.integers(0, chat_format.STATES)
        assert total(other) <= best + 1e-9
    for _ in range(20):  # against all paths
        at_ = int(rng.integers(0, 35))
        (ends,) = chat_format.borders(list(chat_format.chunk_matrices(scores, at(at_), at(5), move)))
        path = chat_format.decode_chunks(scores, at(at_), at(5), move, at(ends[0]), at(ends[1]))[at_ : at_ + 5]
        weight = lambda x: move[chat_format.STATES, x[0]] + sum(scores[at_ + k, b] for k, b in enumerate(x)) + sum(move[a, b] for a, b in zip(x, x[1:]))
        assert weight(path) >= max(map(weight, itertools.product(range(chat_format.STATES), repeat=5))) - 1e-9


@pytest.mark.parametrize("page", [30_000, 60])
def test_chat_format(spark, monkeypatch, page):
    monkeypatch.setattr(chat_format, "PAGE_CHARS", page)
    rng = random.Random(23)
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 3) * 2):
            role = ("user", "assistant")[t % 2]
            rows.append((c, t, role, "what is it?" if role == "user" else "it is a thing that is long.\nand it goes on and on and on and on."))
    rows += [(500, t, ("user", "assistant")[t % 2], "what is it?" if t % 2 == 0 else "it is a thing that is long.\nand it goes on and on and on and on.") for t in range(400)]
    rows += [(None, 0, "user", "what is it?"), (600, 0, None, None), (601, 0, "user", ""), (602, None, "user", "x")]
    got = chat_format.chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    said = {(r["conv_id"], r["turn_no"]): (r["role"], r["rendered"]) for r in got}
    real = [r for r in rows if r[0] is not None and r[0] < 600]
    right = sum(said.get((c, t)) == (role, f"<|{role}|>\n{x}\n<|end|>\n") for c, t, role, x in real)
    assert right > 0.95 * len(real)
    assert (600, 0) not in said and (None, 0) in said
    assert chat_format.chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_lines(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "PAGE_CHARS", 40)
    rows = [(5, 2, "assistant", "b\n\n\nc\n", 1, "x", "y")] * 3 + [(5, 1, "user", " \n\nq " + "z" * 50, 1, "x", "y"), (5, 2, "assistant", "another", 1, "x", "y"), (5, 3, "nobody", "n", 1, "x", "y"), (5, 0, "system", None, 1, "x", "y")]
    clash = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, chunk long, line string, state string")
    pages = chat_format.transcripts(clash)
    lines = chat_format.known_lines(pages).orderBy("chunk", "line_no").collect()
    words = [chat_format.ROLES[r["s"] // 2] if r["s"] is not None else None for r in lines]
    assert len({r["chunk"] for r in lines}) > 1 and words == ["user"] * (words.count("user")) + ["assistant"] * 7 + [None]
    assert [r["gap"] for r in lines if r["line"] == "c"] == [2, 2, 2]
    out = chat_format.chat_format(clash)
    assert out.columns == ["conv_id", "turn_no", "role", "n_lines", "rendered_sha256", "rendered"] and sum(r["n_lines"] for r in out.collect()) == len(lines)


def test_chat_roles_held_out(spark, tmp_path):
    """Line accuracy on conversations that training did not see, by style: what the text alone tells."""
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    pages = chat_format.transcripts(conversations).cache()
    said = chat_format.decoded(pages, f"file://{tmp_path}").select("conv_id", "chunk", "line_no", "state")
    unseen = F.pmod(F.xxhash64("conv_id", F.lit(7)), F.lit(5)) == 0
    both = chat_format.known_lines(pages).where(unseen).select("conv_id", "chunk", "line_no", "s").join(said, ["conv_id", "chunk", "line_no"])
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4)).alias("style")
    role = (F.floor(F.col("s") / 2) == F.floor(F.col("state") / 2)).cast("double")
    got = {r["style"]: (r["role"], r["n"]) for r in both.groupBy(style).agg(F.avg(role).alias("role"), F.count("*").alias("n")).collect()}
    print("held-out role accuracy by style:", got)
    assert sum(a * n for a, n in got.values()) > 0.85 * sum(n for _, n in got.values())
    assert got[0][0] > 0.95


def brute_substring(texts, window):
    seen = set()
    for t in texts:
        w = SPACE_WORDS.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            if x in seen:
                gone[k : k + window] = [True] * window
            seen.add(x)
        yield w, gone


def test_substring_dedup_with_shared_ids(spark):
    """Repeated rows are one document; different texts under one id are told apart by the hash of the text."""
    say = lambda c, n: " ".join(f"{c}{k}" for k in range(n))
    long, short, other = say("a", 400) + " " + say("a", 60), say("b", 30), say("a", 40)
    rows = [(6, long), (6, short), (6, long), (7, other), (7, short + " x"), (None, other), (None, None)]
    got = collections.Counter(tuple(r) for r in substring_dedup.digest(documents(spark, [t for _, t in rows], [i for i, _ in rows]), 20).collect())
    tag = lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).head()[0]
    order = sorted({r for r in rows if r[1]}, key=lambda r: (r[0] is not None, r[0] or 0, tag(r[1])))
    expected = {r: (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()) for r, (w, gone) in zip(order, brute_substring([t for _, t in order], 20))}
    expected[None, None] = (0, 0, hashlib.sha256(b"").hexdigest())
    assert got == collections.Counter((r[0], *expected[r]) for r in rows)


@pytest.mark.parametrize("window,hot", [(20, 256), (5, 2), (20, 1)])
def test_substring_dedup(spark, monkeypatch, window, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 2000)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 3000)
    texts = odd_texts(random.Random(window)) + ["a b " * 100]
    ids = ids_for(texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.digest(documents(spark, texts, ids), window).collect()}
    for i, (w, gone) in zip(ids, brute_substring(texts, window)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert got[i] == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert len(got) == len(texts)


def test_substring_clean(spark):
    rng = random.Random(31)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [f"a1 a2\n{passage} a3", f"b1 b2\n{passage}  b3\nb4", passage, None, "", "short"]
    docs = documents(spark, texts)
    cleaned = substring_dedup.clean(docs, 50)
    assert cleaned.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cleaned.collect()}
    assert got == {0: (texts[0], len(texts[0])), 1: ("b1 b2  b3\nb4", 12), 3: (None, None), 4: ("", 0), 5: ("short", 5)} and rng is not None
    assert substring_dedup.clean(docs.limit(0), 50).count() == 0
    twice = docs.unionAll(docs)  # rows of one doc_id are one document
    assert {(r["doc_id"], r["text"]) for r in substring_dedup.clean(twice, 50).collect()} == {(k, v[0]) for k, v in got.items()}
