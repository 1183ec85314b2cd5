"""The corpus operators as registered queries, and their DuckDB twins.

Each query applies one operator with production parameters to its whole
table and derives the result's columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (alignment, bigru, exact_dedup, itq, lookup_shards, mixing, packing, prefix_trie, simhash, surrogates,
                           token_fst, toxicity, warc)
from orderflow.llm.common import scratch

#: Stands for the secret that a deployment passes.
SURROGATE_KEY = b"a key for tests"
SHINGLE_WORDS, MAX_BITS = 4, 4
OVER_LIMIT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as legacy archives, converted, and the WARC files read back."""
    arc, out = scratch(spark, "arc"), scratch(spark, "warc")
    warc.write_pages_as_arc(table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, out)
    rows = warc.stored(warc.read_warc(warc.archives(spark, out), payload=False).drop("payload", "head"), "warc-rows")
    response = rows.where("type = 'response'").select(F.col("record_id").alias("r_id"), F.col("source_id").alias("refers_to"))
    return rows.join(response, rows.refers_to_id == response.r_id, "left").select(
        F.col("source_id").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.with_crc(pieces).select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                                           "sequence_id", "offset")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = itq.near_duplicates(table(spark, sf_dir, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, toxicity.learn_rows(labels))
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % 5
    return toxicity.score(docs, index).select(
        F.col("id").alias("doc_id"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e["id"].cast("bigint")).alias("nearest"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = surrogates.replace(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return rows.select(F.col("id").alias("doc_id"), "text", "entities")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_groups(table(spark, sf_dir, "documents"), words=SHINGLE_WORDS, max_bits=MAX_BITS)
    return rows.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_fst.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "documents").select("doc_id")
    return lookup_shards.place(keys, "doc_id", lookup_shards.lookup_table(spark)).select("doc_id", "slot", "shard")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return rows.withColumnRenamed("id", "doc_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.share_first_turns(turns))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    net = bigru.train(docs, ~held_out)
    return bigru.identify(docs, net).select(
        F.col("id").alias("doc_id"), F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
        F.col("lang").alias("lang_pred"), "score")


QUERIES = {f.__name__: f for f in (op1_arc_to_warc, op2_packing, op3_embedding_near_dedup, op4_toxicity, op5_surrogates,
                                   op6_exact_dedup, op7_simhash, op8_token_counts, op9_mixing, op10_sharding,
                                   op11_alignment, op12_prefix_trie, op13_language_id)}


def _md5_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_SPACES = r"[\x20\x09-\x0D]+"

ORACLE_SQL = {
    "op1_arc_to_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT *, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS stays FROM p)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= {warc.LEAST_REVISIT} AND page_id <> stays THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= {warc.LEAST_REVISIT} AND page_id <> stays THEN stays END AS refers_to
        FROM g""",
    "op3_embedding_near_dedup": f"""
        WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
        links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
                  WHERE list_cosine_similarity(a.v, b.v) >= {itq.LEAST_COSINE}),
        reach(x, y) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT e.vec_id, (SELECT count(*) FROM links WHERE x = e.vec_id) AS n_links,
               (SELECT min(y) FROM reach WHERE x = e.vec_id) AS component_id,
               e.vec_id = (SELECT min(y) FROM reach WHERE x = e.vec_id) AS kept
        FROM e""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g') AS t
                   FROM documents),
        g AS (SELECT *, count(*) OVER (PARTITION BY t) AS group_size,
                     first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
    "op9_mixing": f"""
        WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
                          coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
        r AS (SELECT *, {_md5_number("'mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest")} AS rank FROM d),
        w AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3.0::DOUBLE * sum(size) AS cap,
                     ([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1])::DOUBLE AS weight FROM r GROUP BY source),
        c AS (SELECT *, cap / weight AS full_at, (SELECT sum(source_size) FROM w) AS total FROM w),
        f AS (SELECT max(a.full_at) AS last FROM c a
              WHERE (SELECT sum(least(b.cap, a.full_at * b.weight)) FROM c b) <= a.total),
        t AS (SELECT source, source_size, CASE WHEN full_at <= last THEN cap ELSE weight *
                ((total - coalesce((SELECT sum(cap) FROM c WHERE full_at <= last), 0)) /
                 (SELECT sum(weight) FROM c WHERE last IS NULL OR full_at > last)) END AS target FROM c, f),
        p AS (SELECT r.*, t.source_size, t.target,
                     r.rank % greatest(1, CAST(ceil(t.source_size / {mixing.BLOCK_WORDS * mixing.SHARD_BLOCKS}.0) AS BIGINT)) AS shard
              FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
        o AS (SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY rank, digest, doc_id ROWS UNBOUNDED PRECEDING) AS finish FROM p),
        u AS (SELECT source, shard, sum(size)::BIGINT AS words, greatest(1, floor(sum(size) / {mixing.BLOCK_WORDS}.0 + 0.5))::BIGINT AS blocks,
                     any_value(target) AS target, any_value(source_size) AS source_size
              FROM p GROUP BY source, shard HAVING sum(size) > 0),
        s AS (SELECT *, target * blocks / source_size AS share FROM u),
        q AS (SELECT source, shard, row_number() OVER (ORDER BY share / (2 * k + 1) DESC, source NULLS LAST, shard) AS place
              FROM (SELECT *, unnest(range(0, 3 * blocks + 2)) AS k FROM s)),
        z AS (SELECT s.*, least(3 * blocks, (SELECT count(*) FROM q WHERE q.source IS NOT DISTINCT FROM s.source AND q.shard = s.shard
                     AND q.place <= (SELECT floor(sum(share) + 0.5) FROM s))) AS quota FROM s),
        b AS (SELECT source, shard, words, blocks, quota, unnest(range(0, blocks)) AS block FROM z),
        x AS (SELECT *, row_number() OVER (PARTITION BY source, shard ORDER BY
                {_md5_number("'mix-block:' || coalesce(source, '') || ':' || shard || ':' || block")}, block) AS drawn FROM b),
        y AS (SELECT source, shard, block * words // blocks AS lo, (block + 1) * words // blocks AS hi,
                     quota // blocks + CASE WHEN drawn <= quota % blocks THEN 1 ELSE 0 END AS times FROM x)
        SELECT o.doc_id, o.size, o.source_size, o.target,
               CAST(coalesce(sum(y.times * greatest(0, least(y.hi, o.finish) - greatest(y.lo, o.finish - o.size))), 0) AS BIGINT) AS taken
        FROM o LEFT JOIN y ON o.source IS NOT DISTINCT FROM y.source AND o.shard = y.shard AND y.lo < o.finish AND y.hi > o.finish - o.size
        GROUP BY ALL""",
    "op12_prefix_trie": """
        WITH RECURSIVE turns AS (SELECT conv_id::BIGINT AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
                       WHERE conv_id IS NOT NULL),
        own AS (SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, left(sha256(length(r) || ':' || r || x), 32)) AS s
                FROM turns GROUP BY c),
        crc(c, pos, v, bits) AS (  -- CRC-32 of the decimal id, a bit at a time
            SELECT c, 0, 4294967295::UBIGINT, 0 FROM own
            UNION ALL
            SELECT c, if(bits = 8, pos + 1, pos),
                   CASE WHEN bits = 0 THEN xor(v, ascii(substr(c::VARCHAR, pos + 1, 1))::UBIGINT)
                        WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END,
                   if(bits = 8, 0, bits + 1)
            FROM crc WHERE pos < length(c::VARCHAR)),
        shared AS (SELECT o.c, (xor(k.v, 4294967295::UBIGINT) % 9)::BIGINT AS h, o.s, coalesce(b.s, []) AS head
                   FROM own o JOIN crc k ON k.c = o.c AND k.pos = length(o.c::VARCHAR) LEFT JOIN own b ON b.c = o.c - o.c % 5),
        rebuilt AS (SELECT c, head[1:h] || s[h + 1:] AS s FROM shared),
        prefixes AS (SELECT c, d, s[1:d] AS p, s[1:d - 1] AS q, d = len(s) AS ends
                     FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
        nodes AS (SELECT p, d, min(c) AS conv_id, any_value(q) AS q, count(*) AS n_convs,
                         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
                         if(d = 0, 0, (count(*) - 1) * coalesce(strlen(p[d].x), 0)) AS own
                  FROM prefixes GROUP BY p, d),
        children AS (SELECT q, count(*) AS n FROM nodes WHERE d > 0 GROUP BY q),
        above AS (SELECT n.p, n.own, c.n IS NULL AS leaf, n.p[1:unnest(range(0, n.d + 1))] AS a
                  FROM nodes n LEFT JOIN children c ON c.q = n.p),
        sums AS (SELECT a, sum(own) AS saved, count(*) FILTER (WHERE leaf) AS leaves FROM above GROUP BY a)
        SELECT n.conv_id, n.d::BIGINT AS depth, CASE WHEN n.d > 0 THEN u.conv_id END AS parent_conv_id, n.n_convs,
               coalesce(c.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.a = n.p LEFT JOIN children c ON c.q = n.p LEFT JOIN nodes u ON u.p = n.q AND u.d = n.d - 1""",
    "op10_sharding": f"""
        WITH RECURSIVE names AS (SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 3, '0') AS shard FROM range({len(lookup_shards.SHARDS)}) r(i)),
        pref AS (SELECT i, k, ({_md5_number("'offset:' || shard")} % {lookup_shards.SLOTS}
                               + k * ({_md5_number("'skip:' || shard")} % {lookup_shards.SLOTS - 1} + 1)) % {lookup_shards.SLOTS} AS slot
                 FROM names, range({lookup_shards.SLOTS}) r(k)),
        fill(turn, slot, free) AS (
            SELECT -1::BIGINT, -1::BIGINT, bitstring('0', {lookup_shards.SLOTS})
            UNION ALL
            SELECT turn + 1, taken, set_bit(free, CAST(taken AS INTEGER), 1) FROM (
                SELECT f.turn, f.free, arg_min(p.slot, p.k) AS taken FROM fill f JOIN pref p ON p.i = (f.turn + 1) % {len(lookup_shards.SHARDS)}
                WHERE f.turn < {lookup_shards.SLOTS - 1} AND get_bit(f.free, CAST(p.slot AS INTEGER)) = 0 GROUP BY f.turn, f.free)),
        owner AS (SELECT f.slot, n.shard FROM fill f JOIN names n ON n.i = f.turn % {len(lookup_shards.SHARDS)} WHERE f.turn >= 0)
        SELECT d.doc_id, o.slot, o.shard FROM documents d JOIN owner o
          ON o.slot = {_md5_number("'key:' || coalesce(CAST(d.doc_id AS VARCHAR), '')")} % {lookup_shards.SLOTS}""",
}
