"""Operators for training data against brute force, with nulls, empty and repeated rows, ties and clashing columns."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.llm import ann, bpe, jaccard_join, kd_shards, language_id, mixing, quality_forest, substring_dedup, toxicity, url_reputation
from tallystone.llm import queries as Q
from tallystone.llm.queries import vocabulary_path

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"
WORDS = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, WORDS, "en", "a", 1, 0.0), (2, "x y " + WORDS, "en", "a", 1, 0.0), (3, None, None, None, None, None), (4, "", "de", "b", 0, 0.0), (5, "one two", "en", "a", 7, 0.0),
    (6, "ONE\ttwo", "en", "a", 7, 0.0), (7, WORDS, "en", None, 1, 0.0), (7, WORDS, "en", None, 1, 0.0), (None, WORDS, "en", "b", 1, 0.0), (9, "a " * 40000, "en", "b", 1, 0.0), (10, "é☃ <|endoftext|>  \n\n x", "fr", "b", 1, 0.0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("chunk", [30_000, 1 << 22])
def test_jaccard_join(docs, chunk):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs, chunk_bytes=chunk).collect()}
    assert got == linked(rows)


def test_jaccard_join_near_threshold(spark):
    rng, rows = np.random.default_rng(5), []
    for i in range(160):  # many near copies around the threshold, and hot shared words
        words = [f"b{k}" for k in range(int(rng.integers(20, 90)))]
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, len(words)))] = f"r{i}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(frame, chunk_bytes=4000).collect()}
    assert got == linked(rows)


def test_similar_sets_look_at_a_common_signature():
    """Pairs at the least similarity, all sizes to 60 and some large: both look at one signature, in the presence of others."""
    rng = np.random.default_rng(8)
    sets, pairs = [], []
    for n in [*range(1, 61), 100, 127, 128, 129, 250, 257, 700, 1024]:
        for _ in range(6):
            own = rng.integers(0, 1 << 63, n).astype(np.uint64)
            gone = int(rng.integers(0, n // 4 + 1))
            new = int((n - gone) * 4 // 3 - n) if rng.integers(0, 2) else 0
            other = np.concatenate((own[gone:], rng.integers(0, 1 << 63, max(new, 0)).astype(np.uint64)))
            common = len(np.intersect1d(own, other))
            if 4 * common >= 3 * (len(np.union1d(own, other))):
                pairs.append((len(sets), len(sets) + 1))
                sets += [np.unique(own), np.unique(other)]
    ends = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    flat = np.concatenate(sets)
    made = np.sort(np.concatenate([m for _, m, _, _ in jaccard_join.signatures(flat, ends, np.arange(len(sets)))]))
    known, counts = np.unique(made, return_counts=True)
    at, key, far = jaccard_join.looked_at(flat, ends, np.arange(len(sets)), known[counts > 1], counts[counts > 1], (3, 4))
    looked = collections.defaultdict(set)
    for a, k in zip(at.tolist(), key.tolist(), strict=True):
        looked[a].add(k)
    assert len(pairs) > 200 and all(looked[a] & looked[b] for a, b in pairs)
    for a, b in pairs:
        least = max(far[at == a].max(), far[at == b].max())
        assert least <= len(np.setxor1d(sets[a], sets[b]))


def test_signatures_are_subsets_of_partitions():
    rng = np.random.default_rng(4)
    one = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
    two = np.sort(np.concatenate((one[1:], rng.integers(0, 1 << 63, 1).astype(np.uint64))))
    ends = np.array([0, len(one), len(one) + len(two)])
    got = [[] for _ in range(2)]
    for row, made, _, spoils in jaccard_join.signatures(np.concatenate((one, two)), ends, np.arange(2)):
        assert spoils == 2
        for i in range(2):
            got[i].append(set(made[row == i].tolist()))
    for a, b in zip(*got, strict=True):  # two differences (one gone, one new) spoil at most two signatures each
        assert 2 <= len(a - b) <= 4 and len(a & b) >= len(a) - 4


def test_sketches_never_tell_more_differences_than_there_are():
    rng = np.random.default_rng(12)
    for n in (1, 2, 31, 32, 33, 300, 2500):
        for gone, new in ((0, 0), (1, 0), (0, 1), (n // 8, n // 8), (n // 4, 0), (0, n // 3), (n // 2, n // 2), (n, n), (n, 5 * n)):
            own = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            other = np.concatenate((own[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)))
            if len(other):
                told = jaccard_join.differ(jaccard_join.parities(own), jaccard_join.parities(other))
                assert told == jaccard_join.differ(jaccard_join.parities(other), jaccard_join.parities(own))
                assert told <= len(np.setxor1d(own, other)) and (gone + new or not told)
                if n >= 300 and gone == new == n // 2:  # a third in common
                    assert 7 * told > len(own) + len(other)


def test_sets_of_pairs_that_sketches_rule_out_do_not_travel(spark, monkeypatch):
    """Documents that meet in rare signatures of a passage but are no links: their sets are not sent."""
    rng, rows = np.random.default_rng(6), []
    for i in range(60):
        rows.append((i, " ".join([*(f"p{k}" for k in range(90)), *(f"r{i}_{k}" for k in range(60 + int(rng.integers(0, 9))))])))
    rows += [(100 + i, t + " x") for i, t in rows[:5]]
    sent, beside = [], jaccard_join._beside

    def counted(pairs, facts):
        sent.append((facts.columns[-1] == "hashes", pairs.count()))
        return beside(pairs, facts)

    monkeypatch.setattr(jaccard_join, "_beside", counted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=4000).collect()}
    assert got == linked(rows)
    told, full = (sum(n for whole, n in sent if whole == w) for w in (False, True))
    assert told > 60 and full <= 10


def test_jaccard_join_odd_rows(odd):
    got = collections.defaultdict(set)
    for r in jaccard_join.join(odd).collect():
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert got[7] == {(56, 1)} and got[2] == {(58, 1)} and got[5] == {(1, 5)} and got[6] == {(1, 5)} and got[3] == {(0, 3)} and got[4] == {(0, 4)} and got[None] == {(56, None)}
    kept = [r["doc_id"] for r in jaccard_join.keep_first(odd).collect()]
    assert sorted(x for x in kept if x) == [1, 3, 4, 5, 9, 10] and kept.count(None) == 1
    assert jaccard_join.join(odd.limit(0)).count() == 0


def removed(rows, width=13):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    rank = lambda i: 1 << 63 if i is None else i
    for i, w in split:
        for j in range(len(w) - width + 1):
            k = tuple(w[j : j + width])
            first[k] = min(first.get(k, 1 << 64), rank(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < rank(i):
                gone[j : j + width] = [True] * width
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("chunk", [20_000, 1 << 22])
def test_substring_dedup(docs, chunk):
    got = substring_dedup.remove_repeats(docs, chunk_bytes=chunk).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(tuple(r) for r in got) == removed([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_substring_dedup_odd_rows(odd):
    got = substring_dedup.remove_repeats(odd).select(F.coalesce("doc_id", F.lit(-1)), "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(tuple(r) for r in got) == removed([(r[0], r[1]) for r in ROWS])
    assert substring_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_bpe_equals_the_library(docs, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    for frame in (docs, odd):
        for r in bpe.encode_decode(frame, vocabulary_path()).collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["ids"] == ids and r["decoded_text"] == library.decode(ids, skip_special_tokens=False)
            assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_decode(odd.limit(0), vocabulary_path()).count() == 0


def test_no_token_bridges_a_cut():
    with open(vocabulary_path(), "rb") as f:
        v = bpe.Vocabulary(f.read())
    text = "a\x00b☃ßx" * 30
    parts = v.cuts(text.encode())
    assert b"".join(parts) == text.encode() and len(parts) > 1
    assert [i for p in parts for i in v.merge(p)] == v.merge(text.encode()) == v._merge_long(text.encode())


def test_ann_recall_and_order(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]]) for i in range(3000)] + [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (None, [1.0] * 24), (5, [float(v) for v in x[5]])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 3000, 20)) and all(len(v) == 20 for v in by.values())
    hits = 0
    for q, found in by.items():
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        hits += len({v for v, _ in found} & set(np.argsort(-s, kind="stable")[:20].tolist()))
        assert [v for v, _ in found] == [v for v, _ in sorted(found, key=lambda t: (-t[1], t[0]))]
        assert all(abs(s[v] - score) < 1e-9 for v, score in found)
    assert hits / (20 * len(by)) >= 0.9
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    few = ann.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 1), (0, 2, 2)]


def test_shards(odd, docs):
    for frame in (odd, docs):
        rows = kd_shards.shards(frame).collect()
        assert len(rows) == frame.count()
        by = collections.defaultdict(list)
        for r in rows:
            by[r["shard"]].append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(8))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    place, size = collections.defaultdict(set), collections.Counter()
    for r in rows:
        place[text[r["doc_id"]]].add(r["shard"])
        size[r["shard"]] += r["size"]
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert all(len(v) == 1 for v in place.values()) and max(size.values()) < 1.25 * sum(size.values()) / 8
    assert kd_shards.shards(odd.limit(0)).count() == 0


def tree_by_brute_force(rows, n):
    """Shard by text: the tree's rule on plain lists."""
    points = []
    for t in rows:
        t = t or ""
        size, white = len(t.encode()) + 1, sum(c in " \t\n\v\f\r" for c in t)
        points.append((size, zlib.crc32(t.encode()), np.log2(size) / 31, min(1, max(0, (size / (len(t) + 1) - 1) / 3)), white / (len(t) + 1)))
    points = np.array(points)
    key = [[(min((1 << 28) - 1, int(p[d] * (1 << 28))) << 32) + int(p[1]) for p in points] for d in (2, 3, 4)]
    spread = lambda ids, d: np.sqrt(np.average((points[ids, d] - np.average(points[ids, d], weights=points[ids, 0])) ** 2, weights=points[ids, 0]))
    every = np.arange(len(rows))
    whole, shard, used = [spread(every, d) for d in (2, 3, 4)], np.zeros(len(rows), int), []

    def split(ids, first, leaves):
        shard[ids] = first
        if leaves < 2 or not len(ids):
            return
        names = kd_shards.DIMENSIONS
        wide = max(range(3), key=lambda d: (round(spread(ids, d + 2) / whole[d], 9), spread(ids, d + 2), names[d]))
        used.append(wide)
        low = leaves // 2
        total = int(points[ids, 0].sum())
        aim, held = -(-total * low // leaves), 0
        order = sorted(ids, key=lambda i: key[wide][i])
        groups = {}
        for i in order:
            groups.setdefault(key[wide][i], []).append(i)
        below = []
        for members in groups.values():
            own = int(points[members, 0].sum())
            if held + own >= aim:
                if held + own - aim <= aim - held:
                    below += members
                break
            held += own
            below += members
        inside = set(below)
        split(np.array(below, int), first, low)
        split(np.array([i for i in ids if i not in inside], int), first + low, leaves - low)

    split(every, 0, n)
    return shard.tolist(), used


@pytest.mark.parametrize("n", [8, 5])
def test_shards_equal_the_tree_by_brute_force(spark, n):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in frame.collect())
    got = {r["doc_id"]: r["shard"] for r in kd_shards.shards(frame, shards=n).collect()}
    want, used = tree_by_brute_force([t for _, t in rows], n)
    assert [got[i] for i, _ in rows] == want and len(set(used)) >= 2


def test_shards_reach_the_target_bytes(docs):
    rows = kd_shards.shards(docs, shards=None, target_bytes=40_000).collect()
    size = collections.Counter()
    for r in rows:
        size[r["shard"]] += r["size"]
    total, largest = sum(size.values()), max(r["size"] for r in rows)
    assert max(size) == -(-total // 40_000) - 1 and max(size.values()) < 40_000 + 3 * largest


def test_shards_stay_on_the_jvm(docs):
    assert "Python" not in kd_shards.shards(docs)._jdf.queryExecution().executedPlan().toString()


def test_mixing(odd, docs):
    rows = mixing.mix(docs, epochs=3.0).collect()
    keys = [r["shuffle_key"] for r in rows]
    assert keys == sorted(keys) and abs(len(rows) - 3 * docs.count()) < 120
    for r in rows:
        assert 0 <= r["copy"] < r["n_copies"]
    again = mixing.mix(docs.repartition(7), epochs=3.0).collect()
    assert [(r["doc_id"], r["copy"]) for r in rows] == [(r["doc_id"], r["copy"]) for r in again]
    assert mixing.mix(odd).columns == [*odd.columns, "rate", "n_copies", "copy", "shuffle_key"] and mixing.mix(odd.limit(0)).count() == 0
    only = {r["source"] for r in mixing.mix(odd, weights={"a": 1.0}).collect()}
    assert only <= {"a"}


def poisson(mean, u):
    p = total = float(np.exp(-mean))
    n = 0
    while total <= u:
        n += 1
        p *= mean / n
        total += p
    return n


def test_mixing_equals_inversion_row_by_row(spark):
    rows = [(i, f"t{i}", "big") for i in range(3000)] + [(5000, "only", "tiny"), (5001, "none", None), (None, "x", "big")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"big": 1.0, "tiny": 2.5, None: 0.1}
    got = collections.defaultdict(list)
    for r in mixing.mix(frame, weights=weights, epochs=0.5).collect():
        got[r["doc_id"]].append((r["copy"], r["n_copies"], r["rate"]))
    size = collections.Counter(s for _, _, s in rows)
    number = lambda *x: int(hashlib.md5(":".join(map(str, x)).encode()).hexdigest()[:13], 16) / 2**52
    for i, _, source in rows:
        rate = weights[source] / 3.6 * len(rows) * 0.5 / size[source]
        pieces = max(1, -int(-rate // mixing.PIECE))
        want = sum(poisson(rate / pieces, number(mixing.SEED, "null" if i is None else i, k)) for k in range(pieces))
        assert sorted(got[i]) == [(k, want, round(rate, 6)) for k in range(want)]
    assert 900 < len(got[5000]) < 1200  # a source of one row, at a rate of 1,042


def test_clashing_and_dotted_names(spark):
    """All operators that pass columns through take any names; what has a new column's name is replaced."""
    frame = spark.createDataFrame([(i, f"{WORDS} {i}", "en", "a", 7, 1.5, i % 2, "u") for i in range(40)], "doc_id long, text string, lang string, source string, n int, `a.b` double, toxic int, _source string")
    frame = frame.withColumn("_id", F.lit(1)).withColumn("c0", F.lit("c")).withColumn("row", F.lit("r")).withColumn("id", F.lit(9)).withColumn("rate", F.lit("old"))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, toxic int, quality int")
    made = {
        "mixing": mixing.mix(frame, epochs=2.0), "language": language_id.identify(frame), "toxicity": toxicity.score(frame, labels), "bpe": bpe.encode_decode(frame, vocabulary_path()),
        "dedup": substring_dedup.remove_repeats(frame), "quality": quality_forest.judge(frame, labels), "first": jaccard_join.keep_first(frame), "join": jaccard_join.join(frame),
    }
    for name, found in made.items():
        rows = found.collect()
        assert len(rows) >= (1 if name == "first" else 40 if name != "mixing" else 20), name
        if name != "join":
            kept = [c for c in frame.columns if c not in ("text", "rate", "n")]
            assert set(kept) <= set(found.columns), name
            for r in rows:
                assert (r["a.b"], r["_source"], r["_id"], r["c0"], r["row"], r["id"], r["toxic"]) == (1.5, "u", 1, "c", "r", 9, r["doc_id"] % 2), name


def test_url_rules_and_reputation(spark):
    urls = [(1, "http://WWW.Example.com/en/x"), (2, "http://a.example.com/en/x?q"), (3, "http://b.net/es/"), (4, "http://b.net/x"), (5, None), (6, "no scheme"), (7, "http://spam.org/#x"), (7, "http://spam.org/#x"), (8, "http://c.com")]
    pages = spark.createDataFrame(urls + [(100 + i, f"http://spam.org/{i}") for i in range(60)] + [(200 + i, f"http://b.net/{i}") for i in range(60)], "page_id long, url string")
    good = spark.createDataFrame([(100 + i, 0) for i in range(60)] + [(200 + i, 1) for i in range(60)] + [(None, 1), (9, None)], "page_id long, good int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge(pages, good, Q.URL_RULES).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow") and got[2] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[3][2:] == ("net/es/", "block") and got[4] == ("b.net", "/x", None, "allow") and got[5][:3] == ("", "", None) and got[6][:3] == ("", "", None)
    assert got[7] == ("spam.org", "/", None, "block") and got[8][:3] == ("c.com", "", None)
    assert url_reputation.judge(pages.limit(0), good.limit(0), Q.URL_RULES).count() == 0


def test_language_id_held_out(spark, odd):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(frame).where("held_out and n_chars > 40").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    got = {r["doc_id"]: r for r in language_id.identify(odd).collect()}
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.identify(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_bundling_by_table_equals_vectors():
    bits = lambda c: 1 - 2 * language_id.letter_bits(np.array([c], np.uint64))[0].astype(int)

    def bundled(text):
        total = np.zeros(language_id.DIMENSIONS)
        for code in language_id.codes(text).tolist():
            a, b, c = code >> 42, code >> 21 & (1 << 21) - 1, code & (1 << 21) - 1
            total += np.roll(bits(a), 2) * np.roll(bits(b), 1) * bits(c)
        return total

    texts = ["abab abba", "xyxy yxxy zz", "漢字かな 漢字"]
    p = language_id.Profiles(["a", "x", "z"], np.array([language_id.bundle(*np.unique(language_id.codes(t), return_counts=True)) for t in texts]))
    for asked in ("abba xyx", "漢字x 漢", "qqqq"):  # n-grams that no language has count as well
        count = np.unique(language_id.codes(asked), return_counts=True)[1]
        got = p.cosines(asked)
        for i, text in enumerate(texts):
            want = bundled(asked) @ bundled(text) / np.linalg.norm(bundled(text)) / np.sqrt(language_id.DIMENSIONS * (count.astype(float) ** 2).sum())
            assert got[i] == pytest.approx(want, rel=1e-3, abs=1e-6)
    assert p.predict("漢字")[0] == "z" and p.predict("12 !") == p.predict(None) == ("und", 0.0)


def test_languages_of_several_scripts_and_many_languages(spark):
    rng = np.random.default_rng(6)
    scripts = {"zh": range(0x4E00, 0x5200), "ja": range(0x3041, 0x3097), "ko": range(0xAC00, 0xB000), "ru": range(0x430, 0x450), "el": range(0x3B1, 0x3CA), "en": range(97, 123)}
    words = {k: ["".join(map(chr, rng.choice(v, rng.integers(2, 5)))) for _ in range(150)] for k, v in scripts.items()}
    rows = [(i, ("" if k in ("zh", "ja") else " ").join(rng.choice(words[k], 60)), k) for i, k in enumerate(list(scripts) * 40)]
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("held_out").collect()
    assert len(got) > 50 and sum(r["lang"] == r["lang_pred"] for r in got) > 0.97 * len(got)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    many = [(i, " ".join([words[i % 300]] * 4), f"l{i % 300:03}") for i in range(1800)]
    profiles = language_id.fit(spark.createDataFrame(many, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert len(profiles.langs) == 300


def test_language_sample_is_bounded(spark):
    """Null ids, repeated ids and repeated rows: at most `sample` rows a language, and no language unlearned."""
    one, two, three = [i for i in range(99) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    rows = [(None, f"null {i}", "a") for i in range(300)] + [(one, f"one {i}", "b") for i in range(300)] + [(two, "same", "c")] * 300 + [(i, f"own {i}", "d") for i in range(300)] + [(three, "rare", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = collections.Counter(r["lang"] for r in language_id.sampled(frame, "doc_id", "text", "lang", 20, 60_000).collect())
    assert set(got) == {"a", "b", "c", "d", "e"} and all(n <= 20 for n in got.values()) and got["c"] == 20 and got["a"] > 10
    few = collections.Counter(r["lang"] for r in language_id.sampled(frame, "doc_id", "text", "lang", 20, 10).collect())
    assert set(few) == {"a", "b", "c", "d", "e"} and all(n <= 2 for n in few.values())


def test_toxicity_learns_sentences_from_documents(spark, odd):
    rng, rows, labels = np.random.default_rng(2), [], []
    for i in range(600):
        bad = i % 3 == 0
        lines = [" ".join(f"c{rng.integers(0, 50)}" for _ in range(8)) for _ in range(5)]
        if bad:
            lines[2] += " vilest"
        rows.append((i, ". ".join(lines)))
        labels.append((i, int(bad)))
    frame, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(frame, known).collect()
    truth = dict(labels)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    for r in held:
        if r["predicted"]:
            assert any("vilest" in r["text"][s["first"] : s["end"]] for s in r["offending"])
    scored = toxicity.score(odd, known.limit(0)).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in scored) and len(scored) == len(ROWS)
    assert toxicity.score(odd.limit(0), known).count() == 0


def test_quality_counts(odd, docs):
    def brute(text):
        text = text or ""
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
        three = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        hit = set()
        for i in range(len(words) - 2):
            if three[tuple(words[i : i + 3])] > 1:
                hit |= {i, i + 1, i + 2}
        return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)

    for frame in (docs, odd):
        for r in frame.collect():
            assert quality_forest.counts(r["text"].encode() if r["text"] is not None else None)[:5] == brute(r["text"])


def test_quality_verdicts(spark, odd):
    frame, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_forest.judge(frame, labels).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2
    got = quality_forest.judge(odd, labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in got) and len(got) == len(ROWS)
    assert quality_forest.judge(odd.limit(0), labels).count() == 0


def pipeline_by_brute_force(spark, frame):
    """The pipeline's rows from plain lists: the fitted profiles, all pairs of documents, all windows, inverted Poisson
    draws and the tokenizers library."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    profiles = language_id.fit(frame, "doc_id", "text", "lang")
    rows = [r.asDict() for r in frame.collect()]
    rows = [r for r in rows if (p := profiles.predict(r["text"]))[0] != "und" and p[1] >= 0.05]
    root = linked([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if root[r["doc_id"]][1] == r["doc_id"]]
    first = {}
    for r in rows:
        w = (r["text"] or "").encode().split()
        for j in range(len(w) - 12):
            first[tuple(w[j : j + 13])] = min(first.get(tuple(w[j : j + 13]), 1 << 62), r["doc_id"])
    for r in rows:
        w = (r["text"] or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < r["doc_id"]:
                gone[j : j + 13] = [True] * 13
        if any(gone):
            r["text"] = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
            r["n_chars"] = len(r["text"])
    size = collections.Counter(r["source"] for r in rows)
    weight = {s: n**mixing.TEMPERATURE for s, n in size.items()}
    out = []
    for r in rows:
        rate = weight[r["source"]] / sum(weight.values()) * len(rows) / size[r["source"]]
        copies = poisson(rate, int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}:0".encode()).hexdigest()[:13], 16) / 2**52)
        ids = library.encode(r["text"], add_special_tokens=False).ids
        sha = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        out += [(r["doc_id"], r["lang"], r["source"], r["n_chars"], len(ids), tuple(ids), sha)] * copies
    return sorted(out, key=repr)


def test_pipeline(spark, docs):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded_sha256"]
    found = sorted(((r["doc_id"], r["lang"], r["source"], r["n_chars"], r["n_tokens"], tuple(r["ids"]), r["decoded_sha256"]) for r in got.collect()), key=repr)
    assert found == pipeline_by_brute_force(spark, docs) and len(found) > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "substring_dedup", "mixing", "bpe"]


def test_pipeline_stages_on_odd_rows(spark, odd):
    """Nulls, empty, long, repeated and clashing: each stage keeps the columns and gives its defined result."""
    import corpus_pipeline

    frame = odd.withColumn("lang", F.when(F.col("doc_id").isin(9), None).otherwise(F.col("lang"))).withColumn("n", F.lit(3)).withColumn("rate", F.lit("r")).withColumn("a.b", F.lit(1.5)).withColumn("row", F.lit(True))
    kept = frame
    for name, stage in corpus_pipeline.STAGES:
        empty, kept = stage(spark, kept.limit(0), DATA), stage(spark, kept, DATA).cache()
        assert empty.count() == 0
        if name != "bpe":
            assert kept.columns == frame.columns
        ids = collections.Counter(r["doc_id"] for r in kept.collect())
        if name == "language_id":
            assert ids[3] == ids[4] == 0 and ids[7] == 2 and ids[None] == 1
        if name == "jaccard_join":
            assert ids[2] == ids[6] == ids[7] == 0 and ids[1] == ids[5] == ids[None] == 1
        if name == "substring_dedup":  # a null id is larger than all others, so its words are the smaller document's
            assert {r["text"] for r in kept.where("doc_id is null").collect()} == {""}
        for r in kept.collect():
            assert (r["n"], r["rate"], r["a.b"], r["row"]) == (3, "r", 1.5, True)


def test_word_hashes():
    from tallystone.llm import words

    texts = [b"", None, b"one Two\x00 one", b"\v\f  ", "é☃ é x".encode(), b"z" * 700_000 + b" z", b"a b " * 200_000]
    got, ends = words.hashed(texts)
    every = [t.split() if t else [] for t in texts]
    assert np.diff(ends).tolist() == [len(w) for w in every] and ends[0] == 0
    flat = [w for t in every for w in t]
    assert len(set(got.tolist())) == len(set(flat)) and len({(g, w) for g, w in zip(got.tolist(), flat, strict=True)}) == len(set(flat))
    assert (words.hashed([b"ONE \xc3\x89Z"], lower=True)[0] == words.hashed([b"one \xc3\x89z"])[0]).all()


def test_shards_start_no_python_worker(spark, docs, monkeypatch):
    """Neither the plan nor what is sent to the nodes goes through Python on an executor."""
    from pyspark.core.context import SparkContext

    def refuse(*_, **__):
        raise AssertionError("an RDD was made")

    monkeypatch.setattr(SparkContext, "parallelize", refuse)
    assert kd_shards.shards(docs).count() == docs.count()


def clustered(n, dims, clusters, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dims)) * 3
    return (middle[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims)) * 0.3).astype(np.float32)


@pytest.mark.parametrize("sample", [20_000, 1200])
def test_ann_recall_where_lists_are_left_out(spark, sample):
    """One level of lists and, with a small sample, two; most lists aren't probed."""
    x = clustered(6000, 16, 60, 4)
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    index = ann.fitted(frame.select("vec_id", F.col("embedding").alias("v")), 16, 6000, 20, sample, 60)
    told = sample // ann.EACH
    assert 50 <= len(index.centers) <= 140 and index.probes <= len(index.centers) / 2 and (len(index.centers) > told) == (sample == 1200)
    hits, asked = 0, 0
    found = collections.defaultdict(set)
    for r in ann.search(frame, sample=sample, per_list=60).collect():
        found[r["query_id"]].add(r["vec_id"])
    for q, got in found.items():
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        hits, asked = hits + len(got & set(np.argsort(-s, kind="stable")[:20].tolist())), asked + 20
    assert len(found) == 300 and hits / asked >= 0.9


def test_ann_ties_go_to_the_smallest_ids_and_lengths_are_apart(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(400 + i, [0.5, i % 7 / 7.0, 1.0]) for i in range(200)] + [(1000 + i, [1.0, float(i)]) for i in range(3)]
    got = collections.defaultdict(list)
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got[0] == [1, 2, 3, 4, 5] and got[20] == [0, 1, 2, 3, 4] and got[1000] == [1001, 1002]


def test_posteriors_by_brute_force(spark):
    rng = np.random.default_rng(9)
    hosts = [(f"{a}.{b}.{c}", float(n), float(rng.integers(0, n + 1))) for a in "xyz" for b in ("one", "two", "three") for c in ("com", "org") for n in [int(rng.integers(0, 30))]]

    def level(rows):  # key, n, good, m
        over = sum((g - n * m) ** 2 - n * m * (1 - m) for _, n, g, m in rows)
        room = sum(n * m * (1 - m) * (n - 1) for _, n, g, m in rows)
        rho = over / room if room > 0 else 0
        k = max(1.0, min(10_000.0, 1 / rho - 1)) if rho > 0 else 10_000.0
        return {key: (k * m + g, k * (1 - m) + n - g) for key, n, g, m in rows}

    def summed(depth):
        out = collections.defaultdict(lambda: [0.0, 0.0])
        for h, n, g in hosts:
            key = ".".join(h.split(".")[-depth:])
            out[key][0] += n
            out[key][1] += g
        return out

    mean = lambda ab: ab[0] / sum(ab)
    m0 = (sum(g for _, _, g in hosts) + 1) / (sum(n for _, n, _ in hosts) + 2)
    one = level([(k, *v, m0) for k, v in summed(1).items()])
    two = level([(k, *v, mean(one[k.split(".")[-1]])) for k, v in summed(2).items()])
    want = level([(h, n, g, mean(two[h.split(".", 1)[1]])) for h, n, g in hosts])
    frame = spark.createDataFrame(hosts, "host string, n double, good double")
    for few in (url_reputation.FEW, 1):  # parents sent to all, and joined by their weight
        url_reputation.FEW, before = few, url_reputation.FEW
        got = {r["host"]: (r["a"], r["b"]) for r in url_reputation.reputation(frame).collect()}
        url_reputation.FEW = before
        assert got.keys() == want.keys() and all(got[h] == pytest.approx(want[h], rel=1e-9) for h in want)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    told = con.sql(Q.oracle_sql()[name])
    df = Q.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    assert sorted(told.columns) == columns
    at = [told.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in told.fetchall())


def test_dense_groups_are_compared_in_blocks(spark, monkeypatch):
    """Documents of one very common passage, most of them just not similar enough: all-against-all by blocks, no link lost."""
    base = [f"b{k}" for k in range(70)]
    rows = [(i, " ".join(base + [f"r{i}_{k}" for k in range(14)])) for i in range(240)]
    rows += [(i, " ".join([*base, *(f"s{k}" for k in range(8)), *(f"r{i}_{k}" for k in range(5))])) for i in range(240, 270)]
    monkeypatch.setattr(jaccard_join, "HOT", 20)
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    seen = []
    blockwise = jaccard_join._blockwise
    monkeypatch.setattr(jaccard_join, "_blockwise", lambda *a: seen.append(1) or blockwise(*a))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == linked(rows) and seen and len({c for _, c in got.values()}) == 241


def test_quality_verdicts_by_brute_force(spark):
    """Each row walked down each tree on its own; the verdict is the base rules' and the threshold's."""
    frame, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    forest = quality_forest.fit(frame, labels, "doc_id", "text")
    expected = quality_forest.Forest._mean_path(forest.size)

    def path(row, tree):
        feature, cut, child, length = tree
        node = 0
        while feature[node] >= 0:
            node = child[node] + (1 if row[feature[node]] > cut[node] else 0)
        return length[node]

    rows = quality_forest.judge(frame, labels).collect()
    for r in rows:
        c = np.array([[r[n] for n in quality_forest.COUNTS]])
        x = quality_forest.rules(c)[0]
        score = 2.0 ** (-sum(path(x, t) for t in forest.trees) / len(forest.trees) / expected)
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["anomaly"] == pytest.approx(score) and r["kept"] == (not failed and score <= forest.threshold)
    assert 0 < sum(r["kept"] for r in rows) < len(rows)


def test_forest_counts_every_labelled_row(spark):
    """6,500 good rows, more than any bounded sample of old: each is in a leaf of each tree, and the threshold is that of
    all scores, good rows' without themselves, by plain sorting."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 1000, 52 + i % 9)) + "." * (i % 5) for i in range(6500)]
    texts += [" ".join(f"W#{k}" for k in rng.integers(0, 1000, 60)) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    labels = spark.createDataFrame([(i, int(i < 6500)) for i in range(len(texts))], "doc_id long, quality int")
    forest = quality_forest.fit(frame, labels, "doc_id", "text")
    assert forest.size == 6500
    x = quality_forest.rules(np.array([quality_forest.counts(t.encode()) for t in texts]))
    feature, cut = quality_forest.drawn(x.min(0), x.max(0))
    held = np.array([np.bincount(leaf, minlength=feature.shape[1] + 1) for leaf in quality_forest.leaves(x[:6500], feature, cut)])
    whole, without = quality_forest.Forest(feature, cut, held), quality_forest.Forest(feature, cut, held, left_out=1)
    assert all((a == b).all() for t, u in zip(whole.trees, forest.trees, strict=True) for a, b in zip(t, u, strict=True))
    for i in (0, 77, 6499):  # the forest without a row is the one grown without it, seen from that row
        less = np.array([h - (np.arange(len(h)) == leaf[0]) for h, leaf in zip(held, quality_forest.leaves(x[i : i + 1], feature, cut), strict=True)])
        other = quality_forest.Forest(feature, cut, less)
        other.size = whole.size
        assert other.score(x[i : i + 1]) == pytest.approx(without.score(x[i : i + 1]))
    g, b = np.sort(without.score(x[:6500])), np.sort(whole.score(x[6500:]))
    at = np.unique(np.concatenate((g, b)))
    kept, found = np.searchsorted(g, at, "right"), np.searchsorted(b, at, "right")
    best = np.argmax(np.where(kept / len(g) >= quality_forest.KEEP, kept * len(b) - found * len(g), -(10**9)))
    assert forest.threshold == pytest.approx((at[best] + at[min(best + 1, len(at) - 1)]) / 2, abs=1e-12)


def test_windows_of_one_hash_are_told_apart_by_their_checks():
    seen, checks = np.array([5, 7, 7, 7, 9], np.uint64), np.array([1, 1, 2, 3, 1], np.uint32)
    asked, own = np.array([5, 5, 7, 7, 7, 8, 9, 99], np.uint64), np.array([1, 2, 3, 1, 4, 1, 1, 1], np.uint32)
    assert substring_dedup._among(asked, own, seen, checks).tolist() == [True, False, True, True, False, False, True, False]
    assert not substring_dedup._among(asked, own, seen[:0], checks[:0]).any()
    to, back, told = substring_dedup._first_later(np.array([4, 4, 4, 4, 6], np.uint64), np.array([0, 2, 1, 3, 1]), np.array([1, 1, 2, 2, 1], np.uint32), 3)
    assert list(zip(to.tolist(), back.tolist(), told.tolist(), strict=True)) == [(2, 4, 1), (3, 4, 2)]


def test_toxicity_scores_by_brute_force(spark, docs):
    """One minus the product of what each sentence leaves, a sentence's probability from the weights of its distinct words."""
    import math
    import re

    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scorer = toxicity.fit(docs, labels, "doc_id", "text")
    assert np.count_nonzero(scorer.weights) > 0
    for r in toxicity.score(docs, labels).collect():
        left = 1.0
        for sentence in re.split(r"[.!?\n]+", r["text"] or ""):
            if sentence.strip():
                z = scorer.bias + sum(scorer.weights[i] for w in set(sentence.split()) for i in toxicity.places_of(w))
                left *= 1 - 1 / (1 + math.exp(-max(-40, min(40, z))))
        assert r["score"] == pytest.approx(1 - left, abs=1e-9) and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_toxicity_fit_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, "word " * 100) for i in range(50)]
    frame, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "learn", lambda texts, y: seen.append(sum(map(len, texts))))
    toxicity.fit(frame, labels, "doc_id", "text", fit_bytes=3000)
    assert 0 < seen[0] <= 3000


def test_a_missing_library_is_an_error():
    """Only the missing folder may pass the entry's guard, not a library that the operators need."""
    import pathlib
    import subprocess
    import sys

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__"
    out = subprocess.run([sys.executable, "-c", code], cwd=pathlib.Path(__file__).parents[2], capture_output=True, text=True, timeout=100)
    assert out.returncode != 0 and "xxhash" in out.stderr
