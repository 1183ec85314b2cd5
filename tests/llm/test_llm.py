"""The corpus operators against brute force, libraries and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import (common, exact_dedup, itq, lookup_shards, mixing, packing, queries, simhash, surrogates, token_fst,
                           toxicity, warc)
from orderflow.llm.components import connected_components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, row string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, repeats, a long text, clashing columns."""
    long = "word " * 60_000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one two three four", "en", "b", 18),
            (4, "one two three four", "en", "b", 18), (None, "one two three four", "en", "b", 18), (5, "one  two three\nfour", "en", "b", 19),
            (6, long, "en", None, len(long)), (7, "Mr John Smith 4111 1111 1111 1111, x@y.example.com", "en", "a", 50)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS)


def every_operator(df):
    path = queries.vocabulary
    return [exact_dedup.exact_groups(df), simhash.simhash_groups(df), mixing.mix(df), packing.pack(df, path("word_bpe_49k.json")),
            token_fst.count_tokens(df, path("byte_bpe_50k.json")), surrogates.replace(df, b"k"),
            lookup_shards.place(df.select("doc_id"), "doc_id", lookup_shards.lookup_table(df.sparkSession, ("a", "b"), 7), 7)]


def test_odd_rows(spark, odd):
    exact, near, mixed, packed, counted, private, placed = [d.toPandas() for d in every_operator(odd)]
    for got in (exact, near, mixed, counted, private, placed):
        assert len(got) == 9
    assert exact.kept.sum() == 4 and exact.group_size.max() == 4  # blank, "one two...", long, name
    assert near[near.id.isin([1, 2, 3])].component.unique().tolist() == [1]
    assert mixed[mixed.id.isin([1, 2, 3])].taken.tolist() == [0, 0, 0]
    assert (mixed.taken <= 3 * mixed["size"]).all()
    assert packed.groupby("row").length.sum().sort_values().tolist()[:3] == [1, 1, 1]
    assert counted[counted.id == 6].n_bytes.item() == 300_000
    text = private[private.id == 7].text.item()
    assert "Smith" not in text and "4111" not in text and "x@y" not in text and text.startswith("Mr ")
    assert private[private.id == 1].text.item() is None


def test_empty_tables(odd):
    assert [d.count() for d in every_operator(odd.limit(0))] == [0] * 7


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    low = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: low[x] for x in linked}


def test_simhash_is_exact(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    copies = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("text", F.concat("text", F.lit(" tail")))
    got = simhash.simhash_groups(docs.unionByName(copies)).toPandas()
    fp = got.fp.to_numpy().view(np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    low = got.id.to_numpy().copy()
    for _ in range(20):
        low = np.array([low[n].min() for n in near])
    assert low.tolist() == got.component.tolist() and got.component.nunique() < len(got)


def test_partition_thresholds_cover_the_distance(spark):
    docs = simhash.fingerprints(spark.read.parquet(f"{SF}/documents.parquet")).select("fp").distinct()
    for bits in (0, 3, 4):
        plan = simhash.plan_partitions(docs, bits)
        assert sum(t + 1 for _, t in plan) == bits + 1
        assert len({b for part, _ in plan for b in part}) == sum(len(p) for p, _ in plan)


def test_itq_finds_the_links(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 32))
    rows = [(i, (base[i % 60] + rng.normal(size=32) * 0.05).tolist(), i % 2) for i in range(600)] + [(600, base[0].tolist(), None)]
    got = itq.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), block=16).toPandas().set_index("id")
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 if r[2] is None else r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label) & (label >= 0)[:, None]
    np.fill_diagonal(near, False)
    assert got.n_links.sum() >= 0.99 * near.sum() and (got.n_links[range(601)].to_numpy() <= near.sum(1)).all()
    assert got.loc[600].n_links == 0 and got.loc[600].kept


def test_itq_finds_the_links_of_vectors_with_a_common_mean():
    for share in (0.0, 0.7, 0.8, 0.9):  # squared norm of the mean
        rng = np.random.default_rng(6)
        unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
        own = unit(rng.normal(size=(3000, 64)))
        mean = unit(rng.normal(size=64))
        x = unit(share ** 0.5 * mean + (1 - share) ** 0.5 * own)
        # partners at the threshold: a step of the right length across
        step = rng.normal(size=x.shape)
        step = unit(step - (step * x).sum(1, keepdims=True) * x)
        y = 0.931 * x + (1 - 0.931 ** 2) ** 0.5 * step
        y = unit(mean * share ** 0.5 + unit(y - mean * share ** 0.5) * (1 - share) ** 0.5)  # as far from the mean as the others
        pairs = (x * y).sum(1) >= 0.93
        codes = itq.plan_codes(np.vstack([x[:2000], y[:2000]]), 4000, 0.93)
        a, b = codes.encode(x[pairs]), codes.encode(y[pairs])
        met = np.zeros(len(a), bool)
        for lo, hi in codes.cuts:
            met |= (a[:, lo:hi] != b[:, lo:hi]).sum(1) <= 1
        found = met & ((a != b).sum(1) <= codes.far)
        assert pairs.sum() > 50 and found.mean() > 0.95, (share, pairs.sum(), found.mean(), len(codes.cuts))


def test_large_buckets_meet_in_parts(spark):
    rows = spark.createDataFrame([(k, 0, 0, n) for k, m in ((1, 200), (2, 5)) for n in range(m)], "key bigint, block bigint, side int, node bigint")
    groups, met = {}, {}
    for r in common.in_parts(rows, 20, F.xxhash64("node")).collect():
        groups.setdefault((r.key, r.block), []).append((r.node, r.side))
    assert max(map(len, groups.values())) < 100 and len([g for g in groups if g[0] == 2]) == 1
    for (key, _), g in groups.items():
        node, side = np.array(g).T
        for i, j in common.pairs_in_groups(np.array([0, len(g)]), side=side):
            for pair in zip(node[i].tolist(), node[j].tolist()):
                met[key, *sorted(pair)] = met.get((key, *sorted(pair)), 0) + 1
    assert len(met) == 200 * 199 // 2 + 10 and set(met.values()) == {1}


def test_simhash_links_in_parts(spark):
    rng = random.Random(4)
    near = [rng.getrandbits(63) for _ in range(3)]
    fps = sorted({n ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(4))) for n in near for _ in range(80)})
    df = spark.createDataFrame([(f, f) for f in fps], "fp bigint, id bigint")
    plan = simhash.plan_partitions(df, 4)
    whole, parts = ({r.vertex: r.component for r in connected_components(simhash.link_edges(df, plan, 4, n)).collect()} for n in (8192, 8))
    assert whole == parts and len(set(whole.values())) >= 3


def test_token_counts_match_the_library():
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    machine, library = token_fst.compiled(path), Tokenizer.from_file(path)
    rng = random.Random(1)
    letters = [*"aaabcdeehilnorst   \n\n\t''''.,!?0123AZ", "'re", "é", "ß", " ", "　", "中", "😀", "\x1c", "\x85", "²", "<|endoftext|>", " the"]
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randrange(60)))
        expected = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.count(text) == expected, text
        plain = text.replace("<|endoftext|>", "")
        assert {machine._count(plain, n) for n in (1, 3, 20)} == {len(library.encode(plain, add_special_tokens=False).ids)}


def test_long_texts_without_late_resets_match_the_library():
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    machine, library = token_fst.compiled(path), Tokenizer.from_file(path)
    for text in ("word next " * 6550 + "x" * 300 + " more" * 1000, "word next " + "ab1," * 20_000, "a b" + " " * 70_000 + "c"):
        assert machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_pieces_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.pack(docs, path).toPandas()
    library = Tokenizer.from_file(path)
    for d in docs.collect()[:80]:
        own = got[got.id == d.doc_id].sort_values("start")
        ids = np.frombuffer(b"".join(own.ids), "<u4").tolist()
        assert ids == library.encode(d.text, add_special_tokens=False).ids + [1]
        assert own.start.tolist() == [0, *own.length.cumsum()[:-1]]
    full = got.groupby("sequence_id").length.sum()
    assert (full <= 2048).all() and all(n == 2048 or n & (n - 1) == 0 for n in full)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum()[:-1]]


def test_packer_takes_the_best_level():
    rng = random.Random(2)
    p = packing.Packer(16)
    for _ in range(300):
        n = rng.randrange(1, 16)
        best = {}
        for h in range(16):
            if h + n <= 16 and (h == 0 or p.count[h]):
                c = p.count.copy()
                c[h] -= h > 0
                c[h + n] += h + n < 16
                best[h] = int((c[1:16] ** 2).sum())
        assert best[p.level_for(n)] == min(best.values())
        p.add("d", bytes(4 * n))


def test_toxicity_search_is_exact_and_learns(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    ix = toxicity.fit(docs, toxicity.learn_rows(labels))
    v = np.zeros((len(ix.ids), len(ix.terms) + 1))
    for t, (place, weight, _) in ix.postings.items():
        v[place, t] = weight
    for d in docs.limit(150).collect():
        terms, weights = ix.vector(ix.counts_of(d.text))
        cosine = v[:, terms] @ weights
        near = ix.nearest(terms, weights, 11)
        assert np.allclose([s for s, _ in near], np.sort(cosine)[::-1][:len(near)])
    got = toxicity.score(docs, ix).toPandas().merge(labels.toPandas(), left_on="id", right_on="doc_id")
    assert ((got.score >= 0.5) == got.toxic).mean() > 0.9
    assert toxicity.score(spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string"), ix).where("score < 0.5").count() == 2
    assert toxicity.fit(docs, labels.limit(0)).ids == []


def test_archives_round_trip(spark, tmp_path):
    big = "x" * 2000
    rows = [(1, "http://a/b c", big), (2, None, big), (2, "http://a/", big), (None, "http://é/", "\r\n\r\nWARC/1.1\r\n"), (4, "u", None)]
    warc.write_pages_as_arc(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2), f"{tmp_path}/arc")
    warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = warc.read_warc(warc.archives(spark, f"{tmp_path}/warc")).toPandas()
    assert len(got) == 5 and got.error.isna().all() and (got.type == "revisit").sum() == 2
    assert b"\r\n\r\nWARC/1.1\r\n" in {bytes(p) for p in got.payload}
    assert got[got.type == "revisit"].payload_bytes.tolist() == [2000, 2000]


def test_both_arc_versions_and_broken_archives():
    v1 = b"filedesc://a.arc 0.0.0.0 1996 text/plain 70\n" + b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n".ljust(70) + b"\n"
    ok = v1 + b"http://a b/ 1.2.3.4 19960923142103 text/html 3\nabc\n"
    (row,) = warc.arc_records(ok)
    assert (row["uri"], row["date"], row["payload"], row["type"]) == ("http://a b/", "1996-09-23T14:21:03Z", b"abc", "resource")
    assert [r["error"] for r in warc.arc_records(ok[:-3])][-1].startswith("cut")
    assert [r["error"] for r in warc.arc_records(ok + b"junk\n")][-1].startswith("not a header")
    assert list(warc.arc_records(b"")) == []


def test_surrogates_stay_distinct_and_agree(spark):
    docs = spark.createDataFrame([(i, f"from 1.2.3.{i % 200} by Mrs X{chr(97 + i % 26)}{chr(97 + i % 7)} y") for i in range(400)], "doc_id int, text string")
    rows = surrogates.replace(docs, b"key").collect()
    names = {}
    for r in rows:
        for e, original in zip(r.entities, surrogates.find(f"from 1.2.3.{r.id % 200} by Mrs X{chr(97 + r.id % 26)}{chr(97 + r.id % 7)} y")):
            names.setdefault((e.type, original[3]), set()).add(e.surrogate)
            assert r.text[e.start:e.end] == e.surrogate
    assert all(len(v) == 1 for v in names.values())
    assert len({(k[0], *v) for k, v in names.items()}) == len(names)
    assert not {(k[0], next(iter(v)).lower()) for k, v in names.items()} & set(names)


def test_surrogates_are_looked_for_wherever_the_patterns_match():
    numbers = ["192.168.1.17", "123-45-6789", "555-123-4567", "4111 1111 1111 1111", "(555) 123-4567", "+1 555 123 4567"]
    names = ["John Smith", "Mr. Smith", "г-н Петров", "Señora Ruiz"]
    rng = random.Random(2)
    for _ in range(3000):
        around = rng.choices(["", "(", ")", "[", '"', " ", "+", "((", "-", "x", ", "], k=4)
        text = around[0] + rng.choice(numbers) + around[1] + " " + around[2] + rng.choice(numbers) + around[3]
        got = [(a, b, kind) for a, b, kind, _ in surrogates.find(text)]
        assert got == [(m.start(), m.end(), m.lastgroup) for m in surrogates._NUMBER.finditer(text)], text
        name = around[0] + rng.choice(names) + around[1]
        found = {(a, b) for a, b, *_ in surrogates.find(name)}
        wanted = {m.span(m.lastindex) for p in (surrogates._NAMED, surrogates._GIVEN_NAMED) for m in p.finditer(name)
                  if m[m.lastindex][0].isupper()}
        assert wanted <= found, name


def test_lookup_table_is_the_turn_taking_one(spark):
    shards, m = tuple("abcde"), 101
    got = {r.slot: r.shard for r in lookup_shards.lookup_table(spark, shards, m).collect()}
    import hashlib
    h = lambda *a: int(hashlib.md5(":".join(a).encode()).hexdigest()[:15], 16)
    own, turn = {}, 0
    while len(own) < m:
        s = shards[turn % 5]
        k = next(x for x in ((h("offset", s) % m + k * (h("skip", s) % (m - 1) + 1)) % m for k in range(m)) if x not in own)
        own[k], turn = s, turn + 1
    assert got == own
    fewer = {r.slot: r.shard for r in lookup_shards.lookup_table(spark, shards[:4], m).collect()}
    assert sum(fewer[s] == got[s] for s in got if got[s] != "e") > 0.6 * m


def test_targets_and_quotas(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 90)], "source string, size bigint")
    t = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert t["a"] == 30 and abs(sum(t.values()) - 1600) < 1e-6  # a is capped
    units = spark.createDataFrame([(i, s) for i, s in enumerate([0.3] * 100 + [1000.0])], "u int, share double")
    got = mixing.sainte_lague(units, "share", ["u"]).agg(F.sum("quota"), F.max("quota")).first()
    assert tuple(got) == (1030, 1030)  # all further quotients of the large unit are higher


def test_the_mix_takes_the_words_of_its_blocks(spark):
    gaps = [" ", "  ", "\n", "\t\n "]
    texts = [" " + "".join(f"w{d}.{i}" + gaps[(d + i) % 4] for i in range(n)) for d, n in enumerate([4000, 1, 700, 90, 130, 2500] * 3)]
    docs = spark.createDataFrame([(d, t, "abc"[d % 3], d) for d, t in enumerate(texts)], "doc_id int, text string, source string, `a.b` int")
    taken = {r.id: (r.taken, r["size"]) for r in mixing.mix(docs).collect()}
    got = mixing.take_mix(docs).collect()
    parts, late = {}, 0
    for r in got:
        parts[r.doc_id] = parts.get(r.doc_id, 0) + len(r.text.split())
        assert r.text in texts[r.doc_id] and r["a.b"] == r.doc_id  # white space as it was
        numbers = [int(w.split(".")[1]) for w in r.text.split()]
        late += numbers[0] > 0 and len(numbers) < taken[r.doc_id][1]
    assert parts == {d: t for d, (t, _) in taken.items() if t}
    assert late > 10  # most runs do not begin with the document
    _, places, block = mixing.plan_mix(docs.withColumn("__row", F.col("doc_id").cast("bigint")), row_col="__row")
    times = {}
    for b in block.collect():
        for w in range(b["from"], b.to):
            times[b.b_source, b.b_shard, w] = b.times
    count = {}
    for r in got:
        for w in r.text.split():
            count[w] = count.get(w, 0) + 1
    for p in places.collect():
        for i in range(p["size"]):
            assert count.get(f"w{p.row}.{i}", 0) == times[p.source, p.shard, p.end - p["size"] + i]


def test_pipeline_keeps_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.drop_copies(spark, docs, SF)
    assert out.columns == docs.columns and out.count() == docs.select("text").distinct().count()
