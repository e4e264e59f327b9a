"""The registered queries of this package: each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.licenses import license_scan

    df = license_scan(_read(spark, sf_dir, "documents"))
    n = F.size("phrases").cast("long")
    base = F.transform("phrases", lambda p: p["label"])
    covered = F.aggregate("detections", F.lit(0).cast("long"), lambda a, d: a + d["last_word"] - d["first_word"] + 1)
    return df.select(
        "doc_id",
        "n_words",
        n.alias("n_base"),
        F.array_min(F.transform("phrases", lambda p: p["first_word"])).alias("first_word"),
        F.array_max(F.transform("phrases", lambda p: p["first_word"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform("detections", lambda d: d["label"]))), ",").alias("labels"),
        F.when(F.col("n_words") > 0, F.least(F.lit(1.0), covered / F.col("n_words"))).otherwise(0.0).alias("score"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels' columns in sequence: quality first, whose probability the model for toxic gets too."""
    from gridprep.llm.toxicity import fit_chain, toxicity

    docs = _read(spark, sf_dir, "documents")
    return toxicity(docs, fit_chain(docs, _read(spark, sf_dir, "labels"), ["quality", "toxic"]))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.ngram_join import ngram_classes

    return ngram_classes(_read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.lines import line_report

    return line_report(_read(spark, sf_dir, "documents"))


#: The rules of the URL query.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.urls import judge_urls

    return judge_urls(_read(spark, sf_dir, "pages"), URL_RULES)


def op5_syncmer_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.syncmers import compare_with_next

    return compare_with_next(_read(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Packs documents with the public word tokenizer and digests the pieces' ids."""
    import public_tokenizers

    from gridprep.llm.packing import pack_documents

    pieces = pack_documents(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_read(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.mixing import mix_documents

    return mix_documents(_read(spark, sf_dir, "documents"), [1, 2, 3])


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.topk import top_k

    return top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.html import extract_pages

    return extract_pages(_read(spark, sf_dir, "pages"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.exact import exact_groups

    return exact_groups(_read(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.codes import code_report

    return code_report(_read(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridprep.llm.collocations import collocations

    return collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_syncmer_fingerprint": op5_syncmer_fingerprint,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_license_scan": op7_license_scan,
    "op8_pack": op8_pack,
    "op9_mix_sources": op9_mix_sources,
    "op10_extract_html": op10_extract_html,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
}

def _codes_sql() -> str:
    """The codes in SQL: each round compares all parts with all entries."""
    square = "list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = ""
    for turn in (0, 1, 2):
        steps += f"""
        a{turn} AS MATERIALIZED (SELECT vec_id, part, x.v, min(struct_pack(d := {square}, entry := c.entry)) AS best FROM x JOIN c{turn} c USING (part) GROUP BY ALL),"""
        if turn < 2:
            steps += f"""
        u{turn} AS (SELECT part, best.entry AS entry, unnest(v) AS value, generate_subscripts(v, 1) AS pos FROM a{turn}),
        m{turn} AS (SELECT part, entry, pos, sum(value) AS s, count(*) AS n FROM u{turn} GROUP BY ALL),
        n{turn} AS (SELECT part, entry, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY pos) AS v FROM m{turn} GROUP BY ALL),
        c{turn + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n{turn}.v, c{turn}.v) AS v FROM c{turn} LEFT JOIN n{turn} USING (part, entry)),"""
    return f"""
        WITH k AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, label, list_transform(embedding, lambda y: CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT)) AS q
          FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
        x AS MATERIALIZED (SELECT vec_id, CAST(part AS INTEGER) AS part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS v FROM k, range(16) t(part)),
        f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 64),
        c0 AS MATERIALIZED (SELECT part, entry, v FROM x JOIN f USING (vec_id)),{steps}
        b AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
        r AS (SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
        SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256 FROM r JOIN k USING (vec_id), b"""


ORACLE: dict[str, str] = {
    "op12_vector_codes": _codes_sql(),
    "op13_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p),
        t AS (SELECT lang, id, unnest(ws) AS w1, generate_subscripts(ws, 1) AS pos FROM (SELECT *, row_number() OVER () AS id FROM w)),
        x AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4 FROM t WINDOW p AS (PARTITION BY id ORDER BY pos)),
        g AS (SELECT lang, 1 AS k, w1 AS phrase FROM x UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM x WHERE w2 IS NOT NULL
          UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM x WHERE w3 IS NOT NULL UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM x WHERE w4 IS NOT NULL),
        f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
        s AS (SELECT c.lang, c.phrase, c.k, c.a, c.ws, j.cut, f1.f AS l, f2.f AS r, CAST(CAST(c.a AS HUGEINT) * 2000000 // (CAST(f1.f AS HUGEINT) + f2.f) AS BIGINT) AS score
          FROM c JOIN range(1, 4) j(cut) ON j.cut < c.k
          JOIN f f1 ON f1.lang = c.lang AND f1.phrase = array_to_string(c.ws[1:j.cut], ' ') AND f1.k = j.cut
          JOIN f f2 ON f2.lang = c.lang AND f2.phrase = array_to_string(c.ws[j.cut + 1:], ' ') AND f2.k = c.k - j.cut),
        b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM s),
        i AS (SELECT c.lang, array_to_string(c.ws[x.first:x.first + y.size - 1], ' ') AS phrase, max(c.a) AS whole
          FROM c JOIN range(2, 4) y(size) ON y.size < c.k JOIN range(1, 4) x(first) ON x.first + y.size - 1 <= c.k GROUP BY 1, 2),
        d AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE b.place = 1 AND (i.whole IS NULL OR 100 * CAST(i.whole AS HUGEINT) < 80 * CAST(b.a AS HUGEINT))),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
        SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, n.n, o.score FROM o JOIN n USING (lang) WHERE o.rank <= 2000""",
    "op11_exact_dedup": """
        WITH t AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS place FROM t)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, place = 1 AS kept, text_sha256 FROM r""",
    "op4_url_filter": r"""
        WITH u AS (
          SELECT page_id,
            coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
          FROM pages),
        m AS (
          SELECT *, CASE
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
            WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
          FROM u)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict FROM m""",
    "op6_exact_top_k": """
        WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
