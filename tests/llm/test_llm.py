import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import compare
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sonde.llm import exact_dedup, language_model, lexical, line_dedup, mixing, packing, quality, queries, resampling, secrets, simhash, suffix, token_counts, topk
from sonde.llm.common import components

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 2500
ODD = [
    (1, "The same text  here", "a"), (2, "The same\ttext here", "a"), (3, None, None), (4, "", "b"), (5, " ", "b"), (None, "null id", None), (6, LONG, "c"), (7, LONG + "end", "c"), (1, "The same text  here", "a"),
    (8, "one\ntwo\nthree\nfour", "a"), (9, "zero\none\ntwo\nthree", "a"), (10, "  two  spaces \n\n ends ", "d"), (11, "ünï çödé <|endoftext|> ▁ 漢字 \U0001f600", "d"), (12, "a\x0bb\x0cc\r\nd", "d"), (-5, "x", "d"),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names the operators use."""
    clash = {c: F.lit("x") for c in ("key", "size", "score", "rank", "h", "n", "spans", "length", "bucket", "target")}
    return spark.createDataFrame(ODD, SCHEMA).withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def bag(rows):
    return collections.Counter(map(tuple, rows))


def test_empty_tables(spark, none):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert token_counts.token_counts(none).count() == 0
    assert topk.exact_topk(vectors).count() == 0
    assert secrets.secret_scan(none, secrets.Forest([])).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    model = quality.fit(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.quality_scores(none, model).count() == 0
    assert suffix.suffix_dedup(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert simhash.simhash_components(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert mixing.mixed_documents(none).columns == none.columns


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_token_counts(which, request):
    import public_tokenizers
    import sentencepiece

    d = request.getfixturevalue(which)
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    want = [(i, len(t.encode()), n := len(sp.encode(t)), n > 4096) for i, t in texts(d)]
    assert bag(token_counts.token_counts(d, memory=50).collect()) == bag(want)


def brute_topk(rows, k=20, step=20):
    ok = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % step == 0}):
        v = next(v for i, v in ok if i == q)
        found = sorted((-int(v @ w), i) for i, w in ok if i != q and len(w) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in centres[i % 5] + 0.1 * rng.normal(size=8)]) for i in range(700)]
    rows += [(i, [0.5] * 8) for i in range(700, 800)]  # one frequent vector
    rows += [(800, None), (820, [None] * 8), (840, [float("nan")] * 8), (860, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (880, [1.0, 2.0]), (900, [3e9] * 8), (901, [3e9] * 8), (5, [float(x) for x in centres[0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(3)
    assert bag(topk.exact_topk(df).collect()) == bag(brute_topk(rows))


def test_cover_tree_covers():
    rng = np.random.default_rng(1)
    tree = topk.build(np.arange(500), rng.integers(-60, 60, (500, 6)), leaf=16)
    assert sorted(tree.ids) == list(range(500))
    for i in range(len(tree.kids)):
        own = tree.points[tree.lo[i] : tree.hi[i]]
        assert np.sqrt(((own - tree.centre[i]) ** 2).sum(1)).max() <= tree.radius[i] + 1e-9
        assert not tree.kids[i] or sum(tree.hi[k] - tree.lo[k] for k in tree.kids[i]) == tree.hi[i] - tree.lo[i]


def test_secrets(odd, docs):
    forest = secrets.fit()
    held = secrets.labelled_findings(600, seed=99)
    guess = forest.chance(np.array([secrets.features(t, a, b) for t, a, b, _ in held])) >= 0.5
    assert (guess == np.array([y for *_, y in held], bool)).mean() > 0.97
    assert secrets.secret_scan(odd, forest).count() == 0
    want = {(i, hashlib.sha256(m.encode()).hexdigest()) for i, t in texts(docs) for m in re.findall('token = "([0-9a-f]{40})"', t)}
    found = {(r["doc_id"], r["secret_sha256"]) for r in secrets.secret_scan(docs, forest).collect() if r["is_secret"]}
    assert want <= found


def test_long_secrets_are_one_candidate():
    rng = random.Random(3)
    for marks, n in (("", 700), ("!%", 900), ("", 5000)):
        long = "eyJ" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789" + marks, k=n))
        assert secrets.candidates(f'api_key: "{long}" and so on') == [(10, 10 + len(long))]


def brute_exact(rows):
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t)) for i, t in rows]
    ids, size, seen, out = {}, collections.Counter(t for _, t in norm), set(), []
    for i, t in norm:
        ids.setdefault(t, []).append(i)
    for i, t in norm:
        keep = min((x for x in ids[t] if x is not None), default=None)
        out.append((i, keep, size[t], i == keep and (i, t) not in seen, hashlib.sha256(t.encode()).hexdigest()))
        seen.add((i, t))
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
@pytest.mark.parametrize("most", [exact_dedup.TRIE_BYTES, 2000])
def test_exact_dedup(which, most, request):
    d = request.getfixturevalue(which)
    assert bag(exact_dedup.exact_dedup(d, most).collect()) == bag(brute_exact(texts(d)))


def test_patricia_spills():
    rng = random.Random(2)
    keys = [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(3000)]
    trie = exact_dedup.Patricia(5000)
    for i, k in enumerate(keys):
        trie.insert(k, (i, 1))
    want = {k: (keys.index(k), keys.count(k)) for k in set(keys)}
    got = list(trie.drain())
    assert len(got) == len(want)
    assert dict(got) == want


def test_quality(spark, odd):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(d, labels)
    rows = quality.quality_scores(d, model).withColumn("held", quality.held_out()).join(labels, "doc_id").where("held").collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93
    whole = quality.Scorer(model)
    some = [(t or "").encode() for _, t, _ in ODD]
    together = whole.scores(some)
    alone = np.array([quality.Scorer(model).scores([t])[0] for t in some])
    assert np.allclose(together, alone)
    assert quality.quality_filter(odd, model, 0.0).columns == odd.columns
    assert quality.quality_filter(odd, model, 0.0).count() == odd.count()


def brute_suffix(rows):
    n, count = suffix.LENGTH, collections.Counter()
    b = [(i, t.encode()) for i, t in rows]
    for _, t in b:
        count.update(xxhash.xxh3_128_digest(t[k : k + n]) for k in range(len(t) - n + 1))
    out = []
    for i, t in b:
        cover = bytearray(len(t))
        for k in range(len(t) - n + 1):
            if count[xxhash.xxh3_128_digest(t[k : k + n])] > 1:
                cover[k : k + n] = b"\1" * n
        kept = bytes(x for x, c in zip(t, cover, strict=True) if not c)
        out.append((i, len(t), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["docs", "odd", "made"])
@pytest.mark.parametrize(("hot", "batch"), [(suffix.HOT, suffix.BATCH), (suffix.HOT, 1500), (3, suffix.BATCH)])
def test_suffix_dedup(spark, which, hot, batch, request):
    if which == "made":
        rng = random.Random(4)
        passage = "".join(rng.choices("abcdef gh", k=900))
        rows = [(i, "".join(rng.choices("xyz w", k=rng.randint(0, 300))) + passage[rng.randint(0, 300) : rng.randint(500, 900)] + "é" * rng.randint(0, 30)) for i in range(60)]
        rows += [(100, "a" * 900), (101, "ab" * 700), (102, passage), (102, passage)]
        d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    else:
        d = request.getfixturevalue(which)
    assert bag(suffix.suffix_dedup(d, hot=hot, batch=batch).collect()) == bag(brute_suffix(texts(d)))


def test_suffix_dedup_of_planted_passages(spark):
    rng = random.Random(6)
    words = lambda n, k: " ".join("".join(rng.choices("abcdefghij", k=k)) for _ in range(n))
    passages = [words(60, 7), words(60, 7), words(51, 6), ""]  # the third has over 50 words, but under 400 bytes
    assert [len(p) for p in passages] == [479, 479, 356, 0]
    rows = [(i, f"{words(70, 5)} {i}{passages[i % 4]}{i} {words(70, 8)}") for i in range(10)]
    found = suffix.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    gone = {i: 479 if i % 4 < 2 else 0 for i, _ in rows}
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in found} == {(i, len(t), gone[i], int(gone[i] > 0)) for i, t in rows}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mix(which, request):
    d = request.getfixturevalue(which)
    rows = mixing.mix(d).collect()
    sizes = [(r["doc_id"], len(re.findall("[^\x20\x09-\x0d]+", r["text"] or ""))) for r in d.collect()]
    assert bag((r["doc_id"], r["size"]) for r in rows) == bag(sizes)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(n for _, n in sizes)
    by = {}
    for r in rows:
        s = by.setdefault(r["source"], [r["source_size"], r["target"], 0])
        s[2] += r["taken"]
    # targets by the rule: share by weight, cut at three times the source, share what was cut again
    names = sorted((x for x in by if x is not None)) + [None] * (None in by)
    left, target = dict(zip(names, [1.0 + i % 3 for i in range(len(names))], strict=True)), {}
    rest = float(total)
    while left:
        over = [s for s, w in left.items() if rest * w / sum(left.values()) > 3 * by[s][0]]
        if not over:
            target |= {s: rest * w / sum(left.values()) for s, w in left.items()}
            break
        for s in over:
            target[s] = 3.0 * by[s][0]
            rest -= target[s]
            del left[s]
    for s, (_, got, taken) in by.items():
        assert got == pytest.approx(target[s])
        assert abs(taken - got) <= 0.5
    assert bag(rows) == bag(mixing.mix(d.repartition(5)).collect())


def test_small_sources_meet_their_targets(spark):
    large = "id as doc_id", "repeat('w ', 20000) as text", "if(id % 2 = 0, 'a', 'z') as source"
    rows = spark.range(500).selectExpr(*large).union(spark.createDataFrame([(1000 + i, "v " * 20, s) for i, s in enumerate("bccddddd")], "doc_id long, text string, source string"))
    by = {r["source"]: r for r in mixing.mix(rows).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    assert [by[s]["target"] for s in "bcd"] == [60, 120, 300]
    assert [by[s]["taken"] for s in "bcd"] == [60, 120, 300]


def test_small_sources_equal_the_sql(spark, tmp_path):
    large = "id as doc_id", "repeat('w ', 20000) as text", "if(id % 2 = 0, 'a', 'z') as source"
    rows = spark.range(60).selectExpr(*large).union(spark.createDataFrame([(1000 + i, "v " * 20, s) for i, s in enumerate("bccddddd")], "doc_id long, text string, source string"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    compare.same(spark, queries.queries()["op7_source_mixing"], mixing.ORACLE_SQL, str(tmp_path))


def test_schedule_gives_every_source_its_share(spark):
    shares = spark.createDataFrame([("a", 0.0, 0.5, 5.0), ("b", 0.5, 0.50000001, 1e-7), (None, 0.50000001, 0.75, 2.5), ("c", 0.75, 0.75, 0.0), ("d", 0.75, 1.0, 2.5)], "source string, lo double, hi double, target double")
    slots = {}
    for r in mixing.schedule(shares, 10_000).collect():
        slots.setdefault(r["source"], []).append((r["rank"], r["slot"]))
    assert {s: len(own) for s, own in slots.items()}["b"] == 1
    for s, share in (("a", 0.5), (None, 0.25), ("d", 0.25)):
        assert abs(len(slots[s]) - share * 10_000) <= 4
    for own in slots.values():
        assert [r for r, _ in sorted(own)] == list(range(len(own)))
        assert [x for _, x in sorted(own)] == sorted(x for _, x in own)


def test_cut_copies_keep_their_bytes(spark):
    text = " \n".join(f"w{i}\tx" for i in range(500))
    rows = spark.createDataFrame([(i, f"\n {i} {text}", "abc"[i % 3]) for i in range(9)], "doc_id long, text string, source string")
    whole = {r["doc_id"]: r["text"] for r in rows.collect()}
    cut = [r for r in mixing.mixed_documents(rows).collect() if r["text"] != whole[r["doc_id"]]]
    assert cut
    assert all(whole[r["doc_id"]].startswith(r["text"]) and whole[r["doc_id"]][len(r["text"])] in " \t\n" for r in cut)


def test_mixed_documents_are_what_was_taken(odd, docs):
    for d in (odd, docs):
        mixed = mixing.mixed_documents(d)
        assert mixed.columns == d.columns
        count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
        got = collections.Counter()
        for r in mixed.collect():
            got[r["doc_id"]] += count(r["text"])
        want = collections.Counter()
        for r in mixing.mix(d).collect():
            want[r["doc_id"]] += r["taken"]
        assert +got == +want


def brute_fp(text, words=4):
    own = re.findall(b"[^\x20\x09-\x0d]+", text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fp, most=4):
    root = {f: f for f in fp}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    own = list(root)
    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    return {f: find(f) for f in own}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_simhash(which, request):
    d = request.getfixturevalue(which)
    rows = [(i, brute_fp(t)) for i, t in texts(d)]
    of = brute_components([f for _, f in rows])
    least = {}
    for i, f in rows:
        if i is not None:
            least[of[f]] = min(i, least.get(of[f], i))
    assert bag(simhash.simhash_components(d).collect()) == bag((i, f"{f:016x}", least.get(of[f])) for i, f in rows)


def test_links_connect_like_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    fp = {rng.getrandbits(64) for _ in range(50)}
    for f in list(fp):
        for _ in range(rng.choice((0, 3, 60))):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 6)):
                g ^= 1 << b
            fp.add(g)
    fp = sorted(fp)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fp]
    found = components(simhash.links(spark.createDataFrame(signed, "fp long")))
    got = {r["node"] % (1 << 64): r["root"] for r in found.collect()}
    want = brute_components(fp)
    groups = lambda m: {frozenset(k for k in fp if m.get(k, k) == r) for r in {m.get(k, k) for k in fp}}
    assert groups(got) == groups(want)
    monkeypatch.setattr(simhash, "DENSE", 8)  # files cut again
    joined = simhash.forest(np.array(fp, np.uint64))
    root = {f: f for f in fp}
    for a, b in joined:
        ra, rb = a, b
        while root[ra] != ra:
            ra = root[ra]
        while root[rb] != rb:
            rb = root[rb]
        root[ra] = rb
    for f in fp:
        while root[root[f]] != root[f]:
            root[f] = root[root[f]]
    assert groups(root) == groups(want)


def test_components_of_a_chain(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_near_stage_keeps_one_of_each_component(spark, odd, docs):
    """The pipeline's near copies are the components of op8: each keeps its first row, whole and unchanged."""
    for d in (odd, docs):
        kept = corpus_pipeline.near_stage(spark, d, SF)
        assert kept.columns == d.columns
        rows = [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()]
        prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
        root = {fp: fp for fp in prints}
        for a in list(root):
            for b in list(root):
                if (a ^ b).bit_count() <= 4 and root[a] != root[b]:
                    old, new = root[a], root[b]
                    root = {fp: new if r == old else r for fp, r in root.items()}
        first: dict = {}
        for (i, _), fp in zip(rows, prints, strict=True):
            first[root[fp]] = min(first.get(root[fp], (True, 0)), (i is None, i or 0))
        got = [(r["doc_id"], root[simhash.fingerprint((r["text"] or "").encode())]) for r in kept.select("doc_id", "text").collect()]
        assert sorted((g, i is None, i or 0) for i, g in got) == sorted((g, *p) for g, p in first.items())


def near_groups(rows, words=5, least=0.8):
    """Brute force: the components of all pairs of texts whose shingles are similar."""
    def own(t):
        w = t.encode().translate(simhash.LOWER).split()
        return {tuple(w[k : k + words]) for k in range(max(len(w) - words, 0) + 1)} if w else set()

    texts = sorted({t or "" for _, t in rows})
    sets = [own(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return dict(zip(texts, group, strict=True))


def test_near_dedup_keeps_one(odd, docs):
    for d in (odd, docs):
        kept = simhash.near_dedup(d)
        assert kept.columns == d.columns
        rows = [tuple(r) for r in d.select("doc_id", "text").collect()]
        group, want = near_groups(rows), {}
        for i, t in rows:
            g = group[t or ""]
            want[g] = min(want.get(g, (True, 0)), (i is None, i or 0))
        got = [tuple(r) for r in kept.select("doc_id", "text").collect()]
        assert sorted(group[t or ""] for _, t in got) == sorted(want)
        assert all((i is None, i or 0) == want[group[t or ""]] for i, t in got)


def test_near_dedup_loses_no_text_whose_key_is_anothers(spark, monkeypatch):
    """Different texts of one 64-bit key stay apart; copies and near copies are found as ever."""
    monkeypatch.setattr(simhash, "text_key", lambda text: F.lit(7).cast("long"))
    base = [" ".join(f"w{(k * 7919 + d * 104729) % 5003}" for k in range(60)) for d in range(5)]
    rows = [*enumerate(base), (10, base[0]), (11, base[1] + " edit"), (12, None), (13, "")]
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 12]


def test_near_dedup_of_planted_copies(spark):
    base = [" ".join(f"w{(k * 7919 + d * 104729) % 5003}" for k in range(300)) for d in range(40)]
    rows = [(d, t) for d, t in enumerate(base)]
    rows += [(1000 + 50 * d + c, " ".join(t.split()[: 7 * c + 3] + ["edit", str(c)] + t.split()[7 * c + 3 :])) for d, t in enumerate(base[:2]) for c in range(40)]
    rows += [(5000, base[5].upper().replace("W", "w ")), (5001, "  " + base[6].replace(" ", "\n"))]
    kept = {r[0] for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect()}
    assert kept == {*range(40), 5000}


def block_edits(rng, n, start):
    """Texts of 200 words and, for each, one with 45 words more at its end or 17 replaced in one block."""
    some = lambda k: [f"x{rng.getrandbits(40)}" for _ in range(k)]
    out = []
    for d in range(n):
        w = some(200)
        cut = rng.randrange(20, 160)
        edited = w + some(45) if d % 2 else w[:cut] + some(17) + w[cut + 17 :]
        out += [(start + d, " ".join(w)), (start + 1000 + d, " ".join(edited))]
    return out


def test_near_dedup_of_block_edits(spark):
    rows = block_edits(random.Random(4), 60, 0)
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == set(range(60))


def test_near_dedup_of_a_crowd(spark, monkeypatch):
    """Texts of one passage with blocks of other words, near and under the similarity: each pair counts, though all share shingles."""
    monkeypatch.setattr(simhash, "BLOCK", 30)
    monkeypatch.setattr(simhash, "PART", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    rng = random.Random(8)
    some = lambda k: [f"y{rng.getrandbits(40)}" for _ in range(k)]
    base, rows = some(200), []
    for d in range(120):
        w, k = list(base), rng.choice((12, 25, 38))
        cut = rng.randrange(0, 200 - k)
        w[cut : cut + k] = some(k)
        rows.append((d, " ".join(w)))
    group, want = near_groups(rows), {}
    for i, t in rows:
        want[group[t]] = min(want.get(group[t], i), i)
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want.values())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_near_dedup_of_nothing(spark):
    assert simhash.near_dedup(spark.createDataFrame([], "doc_id long, text string, fp long, node string")).count() == 0


def brute_lines(rows):
    first, seen = {}, []
    known = []
    for row in rows:  # rows that repeat an id and text are one document
        if row not in known:
            known.append(row)
    order = sorted(known, key=lambda r: (r[0] is None, r[0] or 0))
    covered = collections.defaultdict(set)
    for i, t in order:
        own = t.split("\n")
        for k in range(max(1, len(own) - 2) if t else 0):
            w = tuple(own[k : k + 3])
            if w in first:
                covered[i, t] |= set(range(k, min(k + 3, len(own))))
            else:
                first[w] = seen
    return [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in covered[i, t]), len(covered[i, t])) for i, t in rows]


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_line_dedup(which, request):
    d = request.getfixturevalue(which)
    got = line_dedup.line_dedup(d)
    assert got.columns == [*d.columns, "__lines", "__removed"]
    assert bag((r["doc_id"], r["text"] or "", r["__removed"]) for r in got.collect()) == bag(brute_lines(texts(d)))


def test_short_texts_have_a_window(spark):
    rows = [(1, "one\ntwo"), (2, "one\ntwo"), (3, "one\ntwo\n"), (4, "one"), (5, "one"), (6, "two\none"), (7, ""), (8, ""), (9, None), (10, "one\ntwo\nthree")]
    got = {r["doc_id"]: (r["text"], r["__lines"], r["__removed"]) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in got.items() if r[2]} == {2, 5}
    assert got[2] == ("", 2, 2)
    assert got[5] == ("", 1, 1)
    assert got[7] == got[8] == ("", 1, 0)
    assert got[9] == (None, 0, 0)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing(which, request, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    d = request.getfixturevalue(which)
    lib = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want, total = [], 0
    for i, t in texts(d):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
        total += len(ids)
        cut = [ids[: len(ids) % 1024]] * bool(len(ids) % 1024) + [ids[a : a + 1024] for a in range(len(ids) % 1024, len(ids), 1024)]
        at = 0
        for k, part in enumerate(cut):
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), np.array(part, "<u4").tobytes()))
            at += len(part)
    rows = packing.pack_documents(d).collect()
    assert bag(tuple(r)[:6] for r in [[r[c] if c != "ids" else bytes(r[c]) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")] for r in rows]) == bag(want)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    if which == "docs":
        assert len(by) <= -(-total // 1024) * 1.02 + 1


def test_quick_ids_equal_the_library():
    import public_tokenizers as public

    encoder = packing.Encoder(str(public.path("byte_bpe_50k.json")), str(public.path("byte_bpe_50k.tiktoken")), public.PATTERN, memory=100)
    chars = [chr(c) for c in [*range(0x530), *range(0x2010, 0x2028)]]
    rng = random.Random(8)
    made = ["".join(rng.choices(chars, k=30)) for _ in range(2000)] + [f"a{c}b {c} {c}1 '{c}s" for c in chars] + ["".join(rng.choices("ab \n'sé1,", k=40)) for _ in range(2000)]
    for t in made:
        assert np.frombuffer(encoder.ids(t), "<u4").tolist() == encoder.library.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_text_is_encoded_in_one_call():
    """However many different words it has."""
    import public_tokenizers as public

    encoder = packing.Encoder(str(public.path("byte_bpe_50k.json")), str(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)
    calls, quick = [], encoder.quick
    encoder.quick = type("Counting", (), {"encode_ordinary": lambda _, text: calls.append(text) or quick.encode_ordinary(text)})()
    text = "".join(f"w{i} " for i in range(500)) + "\n the end"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids(""), "<u4").tolist() == []
    assert calls == [text, ""]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = dict(collections.Counter(rng.choice((rng.randint(1, 1024), rng.randint(1, 90), 1024, 600)) for _ in range(rng.choice((0, 1, 40, 5000)))))
    runs, used = packing.plan(counts, groups=rng.choice((3, 50, 400)))
    bins, seen = collections.defaultdict(list), collections.Counter()
    for n, rank, k, seq, offset in runs:
        for i in range(k):
            bins[seq + i].append((offset, n))
            seen[n, rank + i] += 1
    assert seen == collections.Counter({(n, i): 1 for n, c in counts.items() for i in range(c)})
    assert set(bins) == set(range(used))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    import compare

    compare.same(spark, queries.queries()[name], queries.oracle_sql()[name], SF)


def test_pipeline(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == d.columns, name
        assert out.count() > 0, name
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_leaves_without_the_rest():
    """Nothing outside this subpackage imports it but the driver's entry."""
    root = Path(__file__).parents[2]
    for p in (root / "sonde").rglob("*.py"):
        if "llm" not in p.parts:
            assert "sonde.llm" not in p.read_text()


def brute_resample(docs, target, share=10, grams=1, buckets=10_000, seed=2024, least=20):
    """Rows of `resample`, in plain Python."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))

    def of(t):
        w = words(t)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(w) - n + 1)]

    s, t = (collections.Counter(b for x in texts for b in of(x)) for texts in ([x for _, x in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in range(buckets)}
    rows = []
    for i, x in docs:
        own = of(x)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5], r[1]))
    for k, r in enumerate(able[: len(able) * share // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize(("grams", "buckets", "share"), [(1, 10_000, 10), (3, 97, 60)])
def test_resample(spark, odd, docs, grams, buckets, share):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = [r["text"] for r in target.collect()]
    for d, with_target in ((docs, target), (odd, target.select("text").union(spark.createDataFrame([(None,), ("",)], "text string")))):
        got = resampling.resample(d, with_target, share, grams, buckets, least=4)
        assert bag(got.collect()) == bag(brute_resample([(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()], wanted, share, grams, buckets, least=4))
        assert [t for _, t in got.dtypes] == ["bigint"] * 5


def test_resample_of_empty_tables(spark, none, odd):
    empty = spark.createDataFrame([], "text string")
    assert resampling.resample(none, empty).count() == 0
    rows = resampling.resample(odd, empty, least=2)
    assert bag(rows.collect()) == bag(brute_resample([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()], [], least=2))
    with pytest.raises(ValueError, match="buckets"):
        resampling.resample(odd, empty, buckets=0)


def test_ranks_are_places_over_all_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("x"), "id").repartition(7)
    got = resampling.ranked(rows, [F.desc("x"), F.asc("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [(-r["x"], r["id"]) for r in got] == sorted((-r["x"], r["id"]) for r in got)


def brute_search(docs, items, k=20):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def of(t):
        return collections.Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower)))

    rows = [(i, of(t)) for i, t in docs if of(t)]
    n, total, df = len(rows), sum(sum(c.values()) for _, c in rows), collections.Counter(t for _, c in rows for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, collections.Counter()).update(of(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in rows:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, r in wanted.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return out


def test_lexical_search(spark, odd, docs, monkeypatch):
    """Over many shards and blocks of items; ties, repeated rows and items, null ids and texts."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 150)
    items = [(1, "the same TEXT here, here"), (2, None), (3, ""), (4, "two spaces çödé 漢字"), (1, "four"), (None, "lorem ipsum"), (5, "nothing-known")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
    got = lexical.search(lexical.build(odd, postings=10), asked, "item_id")
    assert bag(got.collect()) == bag(brute_search([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()], items))
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    index = lexical.build(docs, postings=3000)
    assert index.where("term is null").count() > 5
    assert bag(lexical.search(index, benchmark, "item_id", k=7).collect()) == bag(brute_search(texts(docs), [(r["item_id"], r["text"]) for r in benchmark.collect()], 7))


def test_lexical_search_of_empty_tables(spark, none, odd):
    items = spark.createDataFrame([(1, "here")], "item_id long, text string")
    assert lexical.search(lexical.build(none), items, "item_id").count() == 0
    assert lexical.search(lexical.build(odd), items.limit(0), "item_id").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_maxscore_equals_full_scores_and_reads_less(seed, monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_WINDOW", 32)
    rng = np.random.default_rng(seed)
    n, full, lists = 4000, np.zeros(4000, np.int64), []
    for size in (5, 40, 300, 2500, 3900, 4000):
        at = np.sort(rng.choice(n, size, replace=False)).astype(np.int32)
        gains = rng.integers(1, 1 + 40_000 // size, size)
        lists.append((lexical.Postings(at, gains, int(gains.max())), int(rng.integers(1, 3))))
        full[at] += gains * lists[-1][1]
    ids = rng.permutation(n)
    found, scores, read = lexical.best(lists, ids, 10)
    want = np.lexsort((ids, -full))[:10]
    assert list(found) == list(want)
    assert list(scores) == list(full[want])
    assert read < sum(len(p.docs) for p, _ in lists) / 2


def test_lengths_beyond_64_bits():
    sizes = np.array([3, 10**12])
    assert list(lexical.lengths(sizes, 10**9, 10**13)) == [75 + 25 * int(x) * 10**9 // 10**13 for x in sizes]


def brute_base(rows):
    own = [(i, (t or "").encode().translate(language_model.LOWER).split() + [b""]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in own]
    c = collections.Counter(w for (_, ws), h in zip(own, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (i, ws), h in zip(own, held, strict=True)]


@pytest.mark.parametrize("hot", [language_model.HOT, 200])
def test_language_model_counts(spark, odd, docs, hot, monkeypatch):
    """Whether tasks hold the counts of most words or meet them by the join."""
    monkeypatch.setattr(language_model, "HOT", hot)
    for d in (odd, docs):
        rows = [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()]
        got = language_model.scores(d).collect()
        assert bag((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == bag(brute_base(rows))
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(language_model, "PIECE", 7)
    for text in (b"", b"  ", b"a bb ccc dddd eeeee ffffff\tggggggg\x0bhhhhhhhhhhhhhhhh i", b"x" * 50, b" Ab" * 9):
        assert [w for part in language_model.pieces(text) for w in part] == text.lower().split()
    assert list(language_model.pieces(None)) == [[]]


def test_language_model_of_an_empty_table(none):
    assert language_model.scores(none).count() == 0


def test_language_model_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    p = rng.random(50) + 0.01
    model = language_model.Model.fresh(p / p.sum(), seed=3)
    model.learn(*(rng.integers(0, 50, 4000).astype(np.uint16) for _ in range(3)), rng)
    one, two, norm = model.tables(rows=7)
    for x1, x2 in rng.integers(0, 50, (20, 2)):
        assert abs(np.exp(one[x1] + two[x2].astype(float) - norm[x1, x2]).sum() - 1) < 1e-4
    assert np.allclose(model.unpacked(model.packed()).packed(), model.packed())


def test_language_model_learns_what_follows_what():
    """A language in which each symbol is followed by one of two: noise-contrastive estimation finds them, and the normalised chance nears a half."""
    rng = np.random.default_rng(5)
    follow = rng.integers(0, 40, (40, 2))
    text = [0]
    for _ in range(60_000):
        text.append(int(follow[text[-1], rng.integers(2)]))
    y = np.array(text, np.uint16)
    x1, x2 = language_model.contexts(y, 0)
    model = language_model.Model.fresh(np.bincount(y, minlength=40) / len(y) * 0.99 + 0.01 / 40)
    model.learn(x1, x2, y, rng)
    one, two, norm = model.tables()
    assert (one[x1, y] + two[x2, y] - norm[x1, x2])[-5000:].mean() > np.log(0.5) - 0.35


def test_language_model_beats_counts_on_held_out_texts(spark):
    rows = language_model.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / n > sum(r["base_score"] for r in rows) / n + 0.15
    assert sum(r["score"] > r["base_score"] for r in rows) > 0.95 * len(rows)
