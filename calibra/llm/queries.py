"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.sizing import scratch_path
from . import bpe, embedding_dedup, fim, hnsw, language, mixing, ordinal, packing, ranked_search, simhash, substring_dedup, token_spans, warc
from .shared import store

LANGUAGES = ["de", "en", "es", "fr"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, directory: fn(lambda table: spark.read.parquet(f"{directory}/{table}.parquet"))
        if sql:
            SQL[name] = sql
        return fn

    return register


@_query("op1_language_id")
def language_id(t):
    """Every document: the declared tag and the source are evidence beside the text."""
    out, names = language.identify(t("documents"), declared="lang", host="source", languages=LANGUAGES)
    return out.select("doc_id", "lang", "source", *names.values())


@_query("language_id_pages")
def language_id_pages(t):
    """Every page: text, declared markup language, address suffix and host; fitted to the markup tags."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))
    pages = t("pages").select(
        "page_id",
        F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<!--.*?-->|<[^>]*>", " ").alias("text"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)), F.lit("")).alias("declared"),
        F.nullif(host, F.lit("")).alias("host"),
    )
    pages = pages.withColumn("suffix", F.substring_index("host", ".", -1))
    out, names = language.identify(pages, declared="declared", host="host", suffix="suffix", languages=LANGUAGES)
    return out.select("page_id", "declared", "host", "suffix", *names.values())


@_query("op2_bpe")
def bpe_round_trip(t):
    encoded = bpe.encode(t("documents"), decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@_query("op3_warc")
def warc_archives(t):
    """Archives are written, read back, and every page's digest is taken from the payload that was read."""
    pages = t("pages")
    path = scratch_path(pages.sparkSession, "warc")
    warc.write_warc(pages, path)
    found = warc.read_warc(pages.sparkSession, path)
    light = store(
        found.select(
            F.col("key").cast("bigint").alias("page_id"),
            "record_type",
            "record_id",
            "refers_to_id",
            F.col("refers_to").cast("bigint").alias("refers_to"),
            F.length("payload").cast("bigint").alias("payload_bytes"),
            warc.sha1_base32(F.col("payload")).alias("payload_digest"),
        ),
        "warc-read",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses, revisits = light.where("record_type = 'response'"), light.where("record_type = 'revisit'")
    bodies = responses.select(F.col("record_id").alias("refers_to_id"), "payload_bytes", "payload_digest")
    revisits = revisits.drop("payload_bytes", "payload_digest").join(bodies.dropDuplicates(["refers_to_id"]), "refers_to_id")
    return responses.select(*columns).unionByName(revisits.select(*columns))


@_query("op4_hnsw")
def hnsw_neighbours(t):
    vectors = t("embeddings")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@_query("op5_quality_classifier")
def quality_classifier(t):
    """Grades: 0 poor, 1 good but toxic, 2 good and not toxic; selected where grade 2 is likely."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    labels = t("labels").where("quality is not null and toxic is not null").select("doc_id", grade.alias("grade"))
    model = ordinal.train(t("documents"), labels)
    out, names = ordinal.grade(t("documents"), model)
    return out.select("doc_id", *names.values())


@_query("op6_token_counts")
def token_counts(t):
    return token_spans.section_tokens(t("documents"), every=True)


@_query("op7_simhash")
def simhash_groups(t):
    found = simhash.simhash_components(t("documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op8_substring_dedup")
def substring_dedup_texts(t):
    """Every document with its text after repeated passages are cut, and where each cut one is kept."""
    docs = t("documents")
    out, names = substring_dedup.dedup_substrings(docs)
    return out.select("doc_id", "text", "n_chars", F.col(names["spans"]).alias("cut"))


@_query("op9_mixing")
def mixing_words(t):
    out, names = mixing.mix(t("documents"))
    size, copies = names["size"], names["copies"]
    return out.select(
        "doc_id",
        F.col(size).alias("size"),
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col(size) * F.col(copies)).alias("taken"),
    )


@_query("op10_embedding_dedup")
def embedding_groups(t):
    return embedding_dedup.embedding_components(t("embeddings"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@_query(
    "op11_ranked_search",
    f"""WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
        held AS (SELECT doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
        total AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS length FROM held),
        tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        item AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        weighed AS (SELECT item_id, term, c * floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS w
            FROM item JOIN df USING (term), total),
        impact AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // length)) AS x
            FROM tf, total),
        scored AS (SELECT item_id, doc_id, sum(w * x)::BIGINT AS score FROM weighed JOIN impact USING (term) GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
)
def ranked_documents(t):
    return ranked_search.search(t("documents"), t("benchmark"))


@_query("op12_best_fit_packing")
def best_fit_packing(t):
    """Pieces give up their ids for a checksum before they travel."""
    pieces = packing.pieces(t("documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces)[0]


@_query(
    "op13_fill_in_middle",
    r"""WITH units AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
            regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
        drawn AS (SELECT *, len(u) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS d FROM units),
        cuts AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 50 THEN 'plain'
                WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
            coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts""",
)
def fill_in_middle(t):
    """The restored text is rebuilt from output and form alone."""
    out, names = fim.transform(t("documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        names["n"],
        names["form"],
        names["prefix_chars"],
        names["middle_chars"],
        F.sha2(F.encode(names["output"], "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(fim.restore(names["output"], names["form"]), "UTF-8"), 256).alias("restored_sha256"),
    )
