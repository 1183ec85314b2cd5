"""Vectors of mixed lengths and sizes, damaged and empty archives."""

import gzip
import itertools
import math
import os
import random

import corpus_pipeline
from orderflow.llm import alignment, common, itq, packing, queries, simhash, toxicity, warc


def test_vectors_of_mixed_lengths_and_odd_components(spark):
    """Near pairs of 24 and 96 components that differ in the first ones only,
    beside vectors that link with nothing."""
    rng = random.Random(4)
    unit = lambda n: [rng.gauss(0, 1) for _ in range(n)]
    rows = []
    for n, many in ((24, 60), (96, 40)):
        for _ in range(many):
            v = unit(n)
            size = math.sqrt(sum(x * x for x in v))
            w = [x + (rng.gauss(0, 1) * size * 0.36 / math.sqrt(n // 3) if i < n // 3 else 0) for i, x in enumerate(v)]
            rows += [v, w]
    rows += [None, [], [0.0] * 24, [1.0] * 23 + [None], [1.0] * 23 + [float("nan")], [float("inf")] + [0.0] * 23]
    big = unit(24)
    rows += [big, [x * 1e200 for x in big], [x * 1e-200 for x in big], big]
    table = [(i, v, None if i % 50 == 49 else 1) for i, v in enumerate(rows)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS node", "2 AS size", "3 AS n")

    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    want = {i: sum(1 for j, w, lb in table if j != i and la == lb == 1 and fine(v) and fine(w) and len(v) == len(w)
                   and cosine(v, w) >= itq.LEAST_COSINE) for i, v, la in table}
    got = {r.id: r.n_links for r in itq.near_duplicates(df).collect()}
    assert sum(want.values()) > 60
    assert sum(got.values()) >= 0.97 * sum(want.values()) and all(got[i] <= want[i] for i in want)
    assert all(got[i] == 0 for i in range(200, 206)) and got[206] == got[207] == got[208] == 3
    assert itq.near_duplicates(df.limit(0)).count() == 0


def arc(*parts):
    body = b"1 0 pages\nURL IP-address Archive-date Content-type Archive-length\n"
    head = b"filedesc://x.arc 0.0.0.0 20000101000000 text/plain %d\n" % len(body)
    return gzip.compress(head + body + b"\n" + b"\n".join(parts))


def record(url, payload):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    return b"%s 1.2.3.4 20000101000000 text/html %d\n" % (url, len(block)) + block


def test_reading_goes_on_at_the_next_header():
    rows = list(warc.arc_records(arc(record(b"http://a/", b"one"), b"garbage here\nmore of it 12", record(b"http://b/", b"two"),
                                     b"http://c/ 1.2.3.4 20000101000000 text/html x", record(b"http://d/", b"four"))))
    assert [r["uri"] for r in rows if not r["error"]] == ["http://a/", "http://b/", "http://d/"]
    assert [r["payload"] for r in rows if not r["error"]] == [b"one", b"two", b"four"]
    assert sum(bool(r["error"]) for r in rows) == 2
    assert list(warc.arc_records(gzip.compress(b""))) == []


def test_convert_counts_and_writes_what_it_could_not_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.arc.gz").write_bytes(arc(record(b"http://a/", b"one"), b"broken line", record(b"http://b/", b"two")))
    (tmp_path / "in" / "b.arc.gz").write_bytes(arc(record(b"http://c/", b"three"), b"http://d/ 1.2.3.4 20000101000000 text/html 999\ncut"))
    out = str(tmp_path / "out")
    assert warc.convert(spark, str(tmp_path / "in"), out) == 2
    read = warc.read_warc(warc.archives(spark, out)).collect()
    assert sorted(r.uri for r in read) == ["http://a/", "http://b/", "http://c/"]
    errors = spark.read.json(out + "-errors").collect()
    assert sorted(r.error.split(":")[0] for r in errors) == ["cut", "not a header"]


def test_pages_with_clashing_names_and_an_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 2000), (2, None, "x" * 2000), (3, "http://b/ c", None)],
                                  "page_id long, url string, html string").selectExpr("*", "7 AS id", "8 AS value", "9 AS record_id")
    for name, rows, n in (("some", pages, 3), ("none", pages.limit(0), 0)):
        arcs, out = str(tmp_path / f"{name}-arc"), str(tmp_path / f"{name}-warc")
        warc.write_pages_as_arc(rows, arcs)
        assert warc.convert(spark, arcs, out) == 0
        got = warc.read_warc(warc.archives(spark, out)).collect()
        assert len(got) == n and sum(r.type == "revisit" for r in got) == (1 if n else 0)


def test_vocabulary_paths_exist():
    assert queries.vocabulary("byte_bpe_50k.json")


def test_alignment_worker_remembers_few_words(monkeypatch):
    """What a worker keeps between tasks stays small, and the ids are the libraries'."""
    import pyarrow as pa

    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "false")
    two = alignment.TwoTokenizers(queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model"))
    held = 0
    for part in range(60):
        names = [" ".join(f"w{part}x{i * 25 + k}qz" + "ab" * 20 for k in range(25)) for i in range(40)]
        (a, bounds_a), (b, bounds_b) = two.encode(pa.array([*names, "  a b", "a  b", "é b"]))
        held = max(held, sum(map(len, two.known)))
    assert held < 2_500_000
    for i, t in enumerate([*names, "  a b", "a  b", "é b"]):
        assert a[bounds_a[i]:bounds_a[i + 1]].tolist() == two.a.encode(" " + t, add_special_tokens=False).ids
        assert b[bounds_b[i]:bounds_b[i + 1]].tolist() == two.b.encode(t)


def test_packing_worker_spends_no_more_than_its_thread(monkeypatch):
    """Words leave Arrow without a scalar each, and the library starts no threads."""
    import pyarrow as pa

    words = ["a", "", "é\x00", "\x1c", "漢字", "the."]
    assert common.strings(pa.array(words), " ") == words and common.strings(pa.array([], pa.string()), " ") == []
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    monkeypatch.delenv("TOKENIZERS_PARALLELISM")
    packing.word_tokens.cache_clear()
    tokens = packing.word_tokens(queries.vocabulary("word_bpe_49k.json"))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    ids, bounds = tokens.encode(pa.array(["", " \t", "of, the"]))
    assert bounds.tolist() == [0, 0, 0, 3] and ids.tolist() == tokens.library.encode("of, the", add_special_tokens=False).ids


def test_worker_of_the_pipeline_remembers_little_and_of_one_operator(spark, monkeypatch):
    """Toxicity, fingerprints and packing run in the same workers, one after
    the other: few words are kept, and none of an operator before."""
    from types import SimpleNamespace

    import pyarrow as pa
    import pyspark
    from pyspark.sql import types as T

    class Docs:  # an operator's own function, to be run here as in one worker
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
        columns = ["id", "text"]
        sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))
        select = lambda self, *_: self
        mapInArrow = lambda self, run, ddl: run

    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["".join(x) for x in itertools.islice(itertools.product("abcdefghijklmnopqrst", repeat=5), 200_000)]
    batch = pa.record_batch({"id": pa.array(range(100)), "text": [" ".join(f"{w}zzzzzzzz" for w in texts[i::100]) for i in range(100)]})
    index = toxicity.build_index([("1", 1, {"bad": 2, "": 3}), ("2", 0, {"": 5})], ["bad"], [1], (1.0, 1.0), 0.5)

    packing.word_tokens.cache_clear()
    assert sum(b.num_rows for b in toxicity.score(Docs(), index, "id", keep=True)(iter([batch]))) == 100
    words = toxicity._MEMORY[index.name][0]
    assert 0 < len(words) <= 64_000 and len({id(x) for x in words.values()}) == 1

    pieces = list(packing.pack(Docs(), queries.vocabulary("word_bpe_49k.json"), "id", memo_chars=corpus_pipeline.MEMO_CHARS)(iter([batch])))
    assert sum(sum(b.column("length").to_pylist()) for b in pieces) > 100_000
    assert not toxicity._MEMORY
    tokens = packing.word_tokens(queries.vocabulary("word_bpe_49k.json"), corpus_pipeline.MEMO_CHARS)
    assert packing.word_tokens.cache_info().currsize == 1 and 0 < sum(map(len, tokens.known)) < 2_000_000  # of 2.6 million
    assert sum(b.num_rows for b in simhash.fingerprints(Docs(), "id")(iter([batch]))) == 100
    assert packing.word_tokens.cache_info().currsize == 0
