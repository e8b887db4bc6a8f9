"""The registered queries: each derives its digest columns from its operator's own output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm import (
    bpe,
    fim,
    langmodel,
    licenses,
    minhash,
    mixing,
    phrases,
    pii,
    repeats,
    rules,
    sharding,
    topk,
    toxicity,
)
from tablestream.llm.common import held_out, n_words, read
from tablestream.llm.registry import query
from tablestream.session import cut_lineage

SHARDS, SHARD_SEED = 8, 17


def _feistel_sql() -> str:
    """The rounds of one permutation step over columns ``x``, ``a`` and ``b``, as nested selects."""
    inner = 'SELECT id, n, a, b, x // b AS l, x % b AS r FROM walk WHERE out'
    for k, key in enumerate(sharding.round_keys(SHARD_SEED)):
        m, t = "ab"[k % 2], f"((r + {key}) % {sharding.PRIME})"
        f = f"((({t} * {t}) % {sharding.PRIME} * {sharding.MULTIPLIER} + {key}) % {sharding.PRIME})"
        inner = f"SELECT id, n, a, b, r AS l, (l + {f}) % {m} AS r FROM ({inner})"
    return f"SELECT id, n, a, b, l * b + r AS x, l * b + r >= n AS out FROM ({inner})"


@query(
    f"""
    WITH RECURSIVE tab AS (
        SELECT list(list_reduce(list_prepend(i, range(8)),
                                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                                                  ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) AS r(i)
    ), sized AS (
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id,
               coalesce(strlen(text), 0) + 1 AS size,
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                              lambda h: ('0x' || h)::BIGINT) AS bytes
        FROM documents
    ), summed AS (
        SELECT id, doc_id, size,
               xor(list_reduce(list_prepend(4294967295, bytes),
                               lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295)
                   AS text_crc32
        FROM sized, tab
    ), shape AS (
        SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM documents
    ), walk AS (
        SELECT id, n, a, (n + a - 1) // a AS b, id AS x, true AS out FROM summed, shape
        UNION ALL
        {_feistel_sql()}
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {SHARDS})::INT AS shard,
           x // {SHARDS} AS slot, NULL::INT AS grown_shard
    FROM walk JOIN summed USING (id) WHERE NOT out
    """
)
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    return sharding.shard_rows(sized, order, SHARDS, SHARD_SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    set_aside = held_out(F.col("doc_id"), 5, 0)
    labels = read(spark, sf_dir, "labels").filter(~set_aside)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", set_aside.alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_spans").cast("long").alias("n_spans"),
    )


@query(
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
            range(greatest(1, len(w) - 4)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) END AS s
        FROM words
    ), members AS (
        SELECT doc_id, unnest(s) AS sh FROM sets
    ), pairs AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM members x JOIN members y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM pairs JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
        WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)
    ), edges AS (
        SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM sets
        UNION
        SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
    ), least AS (
        SELECT a, min(b) AS component_id FROM reach GROUP BY a
    )
    SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN least ON a = doc_id
    """
)
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query(
    """
    WITH texts AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), starts AS (
        SELECT doc_id, h, unnest(range(strlen(h) // 2 - 99)) AS p FROM texts WHERE strlen(h) >= 200
    ), strings AS (
        SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS s FROM starts
    ), repeated AS (
        SELECT doc_id, p FROM (
            SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM strings)
        WHERE k > 1
    ), spans AS (
        SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM (
            SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
                SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100
                                       THEN 0 ELSE 1 END AS fresh FROM repeated))
        GROUP BY ALL
    ), gaps AS (
        SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y, b, a
        FROM spans
    ), kept AS (
        SELECT g.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
               string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY a)
                   || substr(any_value(h), 2 * max(b) + 1) AS rest
        FROM gaps g JOIN texts USING (doc_id) GROUP BY g.doc_id
    )
    SELECT doc_id, strlen(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)
    """
)
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs, texts=False)


@query()
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mixing.mix(docs, F.col("size")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate",
    )


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cut_lineage(rules.statistics(read(spark, sf_dir, "documents").select("doc_id", "text")))
    learned = rules.learn(stats, read(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), rules.verdict(learned).alias("rule"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@query(
    """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    )
    SELECT * FROM (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id, score FROM scored)
    WHERE rank <= 10
    """
)
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.nearest(rows, 10, F.col("vec_id") % 100 == 0)


@query()
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


@query()
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langmodel.score_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), 7, 2)


@query(
    """
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
               sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents
    ), drawn AS (
        SELECT doc_id, text, t, len(t)::BIGINT AS n,
               ('0x' || substr(h, 1, 8))::BIGINT % (len(t) + 1) AS a,
               ('0x' || substr(h, 9, 8))::BIGINT % (len(t) + 1) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                    WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM cut
    ), parts AS (
        SELECT doc_id, text, n, form, array_to_string(t[:least(a, b)], '') AS prefix,
               array_to_string(t[least(a, b) + 1:greatest(a, b)], '') AS middle,
               array_to_string(t[greatest(a, b) + 1:], '') AS suffix
        FROM drawn
    )
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                            WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    again = fim.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


@query(
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?
-
]')) AS piece
        FROM documents
    ), words AS (
        SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces
    ), starts AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
    ), grams AS (
        SELECT lang, w[i:i + k - 1] AS g
        FROM starts, range(1, 6) AS lengths(k) WHERE i + k - 1 <= len(w)
    ), counted AS (
        SELECT lang, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
    ), totals AS (
        SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
    ), cuts AS (
        SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM counted WHERE len(g) > 1
    ), scored AS (
        SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, n,
               ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN counted x ON x.lang = c.lang AND x.g = c.g[:k]
             JOIN counted y ON y.lang = c.lang AND y.g = c.g[k + 1:]
             JOIN totals t ON t.lang = c.lang
    ), best AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM scored)
        WHERE place = 1
    ), inside AS (
        SELECT lang, f, g[i:i + k - 1] AS g
        FROM counted, range(1, 5) AS starts(i), range(2, 5) AS lengths(k)
        WHERE k < len(g) AND i + k - 1 <= len(g)
    )
    SELECT * FROM (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
               array_to_string(g, ' ') AS phrase, a, l, r, n, score
        FROM best b
        WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.g = b.g AND 100 * i.f >= 100 * b.a))
    WHERE rank <= 2000
    """
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(read(spark, sf_dir, "documents").select("lang", "text"))
    return phrases.top(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pii.fit(pii.examples(spark))
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        *(
            pii.number_of(F.col("pattern_spans"), kind).alias(f"n_{kind}") for kind in pii.KINDS
        ),
        F.sha2(pii.listed(F.col("pattern_spans")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("pii_spans")).alias("spans"),
    )
