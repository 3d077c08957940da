"""Registered queries of this subpackage: each operator over the whole of its table, and SQL where SQL can say it."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom_dedup, chat, collocations, hnsw, kd_shards, packing, pieces, pii, quality, secret_scan, simhash, spelling, toxicity

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 8
MODEL_FILES = {"json": "byte_bpe_50k.json", "ranks": "byte_bpe_50k.tiktoken", "pieces": "piece_bpe_32k.model"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; it is installed on every machine and never copied."""
    import public_tokenizers

    return str(public_tokenizers.path(MODEL_FILES[name]))


def byte_bpe():
    """Makes the encoder of the packing query in each task."""
    json_path, ranks_path, build = vocabulary("json"), vocabulary("ranks"), packing.byte_bpe_encoder
    return lambda: build(json_path, ranks_path)


def _count(joined: str, kind: str):
    """How many spans of a kind a joined list has."""
    return F.size(F.filter(F.split(joined, ","), lambda s: s.startswith(f"{kind}:"))).cast("long")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_copies(_table(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedup.copies(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[_count("base_text", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2("base_text", 256).alias("base_sha256"),
        F.col("span_text").alias("spans"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    probe = spark.range(2).select(
        F.lit(-7).cast(table.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(table.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table.select("conv_id", "turn", "role", "text").unionAll(probe)
    whole = chat.assemble(chat.format_turns(rows)).withColumn("turns", chat.read_back(F.col("formatted")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = chat.loss_text(F.col("segments"))
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias("toxic_spans"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[_count("base_text", k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2("base_text", 256).alias("base_sha256"),
        F.col("span_text").alias("spans"),
    )


def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), vocabulary("pieces"))


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.with_slots(kd_shards.assign(_table(spark, sf_dir, "documents"), shards=SHARDS))
    return placed.select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(_table(spark, sf_dir, "documents"))


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), byte_bpe())


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.score(docs, labels).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_exact_dedup,
        op3_secret_scan,
        op4_chat_format,
        op5_toxicity,
        op6_pii,
        op7_sampled_pieces,
        op8_kd_shards,
        op9_simhash_near_dedup,
        op10_harmonic_packing,
        op11_quality,
        op12_spelling_variants,
        op13_collocations,
    )
}

# Escaping as one pattern per control string, since RE2 has no look-ahead.
_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[/TURN]", "[TEXT]")


def _escaped(column: str) -> str:
    out = column
    for c in _CONTROLS:
        first, rest = ("\\" + c[0]), c[1:].replace("[", "\\[").replace("]", "\\]")
        out = f"regexp_replace({out}, '({first})(\\\\*)({rest})', '\\1\\2\\\\\\3', 'g')"
    return out


ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
            FROM documents
        ), g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
        FROM t JOIN g USING (h)
    """,
    "op4_chat_format": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), f AS (
            SELECT *, lag(role) OVER w AS before, lead(turn) OVER w IS NULL AS is_last,
                CASE role WHEN 'system' THEN '<<SYS>> ' || {_escaped("text")} || ' <</SYS>>'
                    WHEN 'user' THEN '<s>[INST] ' || {_escaped("text")} || ' [/INST]'
                    WHEN 'assistant' THEN ' ' || {_escaped("text")} || ' </s>'
                    ELSE '[TURN] ' || {_escaped("role")} || ' [TEXT] ' || {_escaped("text")} || ' [/TURN]' END AS shown
            FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(length(shown))::BIGINT AS formatted_chars,
            bool_and(CASE role WHEN 'system' THEN before IS NULL
                WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END)
                AND bool_or(is_last AND role = 'assistant') AS valid
        FROM f GROUP BY conv_id
    """,
    # CRC-32 is linear: that of a message is the CRC-32 of as many zero bytes, xor one term for each byte and its
    # distance from the end. Terms and zero messages come from the byte-wise rule.
    "op12_spelling_variants": """
        WITH RECURSIVE bits AS (
            SELECT b, b AS c, 0 AS step FROM range(256) AS t(b)
            UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
        ), one AS (SELECT b, c FROM bits WHERE step = 8),
        runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run
            FROM documents
        ), each AS (
            SELECT run, d || ':' || run AS said, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY d, run
        ), longest AS (SELECT max(octet_length(encode(said))) AS m FROM each),
        terms AS (
            SELECT b, c, 0 AS back FROM one
            UNION ALL SELECT t.b, xor(t.c >> 8, o.c), back + 1 FROM terms t JOIN one o ON o.b = t.c & 255 WHERE back < (SELECT m FROM longest)
        ), zeros AS (
            SELECT 4294967295::BIGINT AS c, 0 AS size
            UNION ALL SELECT xor(z.c >> 8, o.c), size + 1 FROM zeros z JOIN one o ON o.b = z.c & 255 WHERE size < (SELECT m FROM longest)
        ), numbered AS (SELECT row_number() OVER () AS id, run, n, hex(encode(said)) AS h FROM each),
        places AS (SELECT id, h, octet_length(encode(h)) // 2 AS size, unnest(range(octet_length(encode(h)) // 2)) AS i FROM numbered),
        byte AS (SELECT id, size, size - 1 - i AS back, ('0x' || substr(h, 2 * i + 1, 2))::INT AS b FROM places),
        crc AS (
            SELECT id, xor(xor(bit_xor(t.c), any_value(z.c)), 4294967295) AS crc
            FROM byte JOIN terms t USING (b, back) JOIN zeros z USING (size) GROUP BY id
        ), kept AS (
            SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word, n
            FROM numbered JOIN crc USING (id)
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
        less AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM cut),
        pairs AS (
            SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM less x JOIN less y USING (i, a, z) WHERE x.word <> y.word
            UNION SELECT x.word, x.n, w.word, w.n FROM less x JOIN words w ON w.word = x.a || x.z
            UNION SELECT w.word, w.n, x.word, x.n FROM less x JOIN words w ON w.word = x.a || x.z
        ), best AS (
            SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM pairs GROUP BY word, n
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
                CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS at FROM words
            UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
        ), roots AS (SELECT c.word, c.at AS root FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """,
    "op13_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents WHERE text IS NOT NULL
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
        grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase
            FROM w, range(1, 5) AS t(k) WHERE len(ws) >= k
        ), f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
        total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
            FROM cand c, range(1, 4) AS t(j)
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:j], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[j + 1:], ' ')
            WHERE j < c.k
        ), low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        parts AS (
            SELECT lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(ws[i : i + m - 1], ' '))))) AS phrase, a
            FROM cand WHERE k > 2
        ), inside AS (SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL),
        ranked AS (
            SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(low.phrase)) AS rank
            FROM low LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
}
