"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchcost.llm import (
    ann,
    bpe,
    decontaminate,
    merkle,
    mixing,
    near_dup,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from branchcost.llm.common import ascii_lower, table
from branchcost.llm.labelled import hash_remainder

#: The site rules that op3 applies.
SITE_RULES = [
    url_filter.SiteRule("net", "/", "block"),
    url_filter.SiteRule("example.net", "/en/", "allow"),
    url_filter.SiteRule("example.com", "/de/", "block"),
    url_filter.SiteRule("org", "/fr/", "allow"),
]


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page, written to archives and read back."""
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _scored(docs: DataFrame, score, held_out) -> DataFrame:
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels whose hash remainder modulo 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    remainder = hash_remainder(F.col("doc_id"), 5)
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"), remainder != 0)
    return _scored(docs, toxicity.score_column(docs, model), remainder == 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels whose hash remainder modulo 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    remainder = hash_remainder(F.col("doc_id"), 3)
    model = quality.train_model(docs, table(spark, sf_dir, "labels"), remainder != 1)
    return _scored(docs, quality.score_column(docs, model), remainder == 1)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words found in every document."""
    hit = F.col("hit")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"), "hit").select(
        "doc_id",
        hit["n_words"].alias("n_words"),
        hit["n_hit"].alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        decontaminate.items_digest(hit["items"]).alias("items_sha256"),
        decontaminate.is_contaminated(hit).alias("contaminated"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), "page_id", "url", SITE_RULES)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    kinds = ("assign", "access", "hex")
    count = {f"n_{k}": F.size(secrets.of_kinds(spans, k)).cast("long") for k in kinds}
    found = secrets.scan_secrets(docs, "spans").withColumns(count)
    return found.select(
        "doc_id",
        *count,
        F.sha2(secrets.joined(spans, kinds).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 50 bytes leave of every document."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector; a deviation beyond a long is null."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents, with the proofs folded over texts of which a fifth is tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(hash_remainder(F.col("doc_id"), 5) == 0, ascii_lower(F.col("text")))
    found = merkle.document_manifest(docs, tampered)
    root = merkle.folded(F.col("shown"), F.col("proof"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(F.col("proof")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encode_documents(docs, path, "encoded", round_trip=True).select("doc_id", "encoded.*")
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_nearest": op5_nearest,
    "op6_decontaminate": op6_decontaminate,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_mix_sources": op8_mix_sources,
    "op9_secrets": op9_secrets,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_bpe": op13_bpe,
}

OP2_SQL = r"""
WITH payloads AS (
    SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha1(COALESCE(html, '')) AS hex FROM pages
), firsts AS (
    SELECT hex, min(page_id) AS first_id FROM payloads GROUP BY hex
), coded AS (
    SELECT p.*, f.first_id,
           list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform(range(0, 4), lambda c:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5))::INTEGER >> (15 - 5 * c)::INTEGER) & 31) + 1, 1)),
               'string_agg', '')), 'string_agg', '') AS payload_digest
    FROM payloads p JOIN firsts f USING (hex)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM coded
"""

OP3_SQL = r"""
WITH parts AS (
    SELECT page_id, url,
           COALESCE(translate(regexp_extract(url, '(?s)://([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           COALESCE(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), judged AS (
    SELECT *,
           CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
           COALESCE(regexp_matches(url, '(?i)^[^/]*://([^/?#]*\.)?(ads?|adserver|banner)[-.]track(er|ing)?\.')
                 OR regexp_matches(url, '(?i)^[^/]*://([^/?#]*\.)?free-(bets|casino|poker)\.')
                 OR regexp_matches(url, '(?i)^[^/]*://([^/?#]*\.)?(online-)?casino\.')
                 OR regexp_matches(url, '(?i)^[^/]*://([^/?#]*[.-])?porn[.-]'), false) AS unwanted
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN unwanted THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP6_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n,
           array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS gram
    FROM item_words, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i) WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT n FROM windows
), hits AS (
    SELECT d.doc_id, d.i, v.n, v.item_id
    FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
          FROM doc_words, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)) d
    JOIN windows v ON v.n = d.n AND v.gram = d.gram
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, LATERAL (SELECT unnest(range(i, i + n)) AS p) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(ids, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP7_SQL = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS shingle
    FROM doc_words, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_have
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)
), neighbours AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reached AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT reached.doc_id, v FROM reached JOIN neighbours ON u = r
), components AS (
    SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, COALESCE(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP8_SQL = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           md5(concat_ws(':', '{mixing.SEED}', CAST(doc_id AS VARCHAR))) AS hex
    FROM documents
), totals AS (
    SELECT source, sum(size) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT source, source_size, {mixing.CAP} * CAST(source_size AS DOUBLE) AS cap,
           CAST(list_extract({list(mixing.WEIGHTS)}, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1) AS DOUBLE) AS weight
    FROM totals
), levels AS (
    -- filled to the cap in the order of cap / weight: the level that the budget allows the sources not yet full
    SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {mixing.SHARE} - COALESCE(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)
), targets AS (
    SELECT source, CAST(source_size AS BIGINT) AS source_size, least(cap, COALESCE(weight * common, cap)) AS target
    FROM levels, (SELECT max(level) AS common FROM levels WHERE cap > weight * level)
), plans AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets
), placed AS (
    SELECT doc_id, size, source_size, target, epochs, CAST(floor(target) AS BIGINT) - epochs * source_size
               - COALESCE(sum(size) OVER (PARTITION BY s.source ORDER BY substr(hex, 1, {mixing.KEY_BITS // 4}), doc_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
    FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, room)) AS BIGINT) AS taken FROM placed
"""

OP10_SQL = """
WITH hexed AS (
    SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents
), pieces AS (
    -- 256 window starts each, so that a window is cut from a short text
    SELECT doc_id, p, substr(h, 512 * p + 1, 610) AS piece
    FROM hexed, LATERAL (SELECT unnest(range(0, len(h) // 512 + 1)) AS p)
), windows AS (
    SELECT doc_id, 256 * p + k AS i, substr(piece, 2 * k + 1, 100) AS w
    FROM pieces, LATERAL (SELECT unnest(range(0, greatest(0, len(piece) // 2 - 49))) AS k)
), firsts AS (
    SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), starts AS (
    SELECT v.doc_id, v.i, v.i > lag(v.i, 1, -100) OVER (PARTITION BY v.doc_id ORDER BY v.i) + 50 AS opens
    FROM windows v JOIN firsts f ON f.w = v.w AND f.first_id < v.doc_id
), numbered AS (
    SELECT doc_id, i, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts
), runs AS (
    SELECT doc_id, run, min(i) AS first, max(i) + 50 AS past FROM numbered GROUP BY doc_id, run
), gaps AS (
    SELECT *, lag(past, 1, 0) OVER (PARTITION BY doc_id ORDER BY first) AS since FROM runs
), kept AS (
    SELECT doc_id, sum(past - first) AS n_removed, count(*) AS n_spans, max(past) AS last,
           string_agg(substr(h, 2 * since + 1, 2 * (first - since)), '' ORDER BY first) AS head
    FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
       sha256(unhex(COALESCE(head, '') || substr(h, 2 * COALESCE(last, 0) + 1))) AS kept_sha256
FROM hexed LEFT JOIN kept USING (doc_id)
"""


def _merkle_sql(levels: int = 5, top_levels: int = 3) -> str:
    """Leaves, then runs of 16 level by level; enough levels for 16**levels rows of a source."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),"
        " lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),"
        " lambda r, bit: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295)"
    )
    value = lambda c: f"COALESCE(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"WITH leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(low)} AS other, {crc} % 5 = 0 AS tampered FROM documents)",
        "ranked AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,"
        " row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)",
        "s0 AS (SELECT doc_id, leaf, grp, pos, CASE WHEN tampered THEN other ELSE leaf END AS node, '' AS proof FROM ranked)",
        "n0 AS (SELECT grp, pos AS idx, leaf AS digest, count(*) OVER (PARTITION BY grp) AS size FROM ranked)",
    ]
    for k in range(levels + top_levels):
        if k == levels:  # from here on the subroots are one group
            steps += [
                f"subroots AS (SELECT grp AS source_no, digest AS subroot FROM n{k})",
                "top AS (SELECT 0 AS grp, source_no AS idx, subroot AS digest, count(*) OVER () AS size FROM subroots)",
                f"joint AS (SELECT doc_id, leaf, 0 AS grp, grp AS source_no, grp AS pos, node, proof FROM s{k})",
            ]
        nodes, rows = ("top", "joint") if k == levels else (f"n{k}", f"s{k}")
        extra = "s.source_no, " if k >= levels else ""
        left, right = "substr(r.digests, 1, 64 * (s.pos % 16))", "substr(r.digests, 64 * (s.pos % 16) + 65)"
        steps += [
            f"r{k} AS (SELECT grp, idx // 16 AS run, string_agg(digest, '' ORDER BY idx) AS digests, max(size) AS size FROM {nodes} GROUP BY ALL)",
            f"n{k + 1} AS (SELECT grp, run AS idx, CASE WHEN size = 1 THEN digests ELSE sha256(digests) END AS digest,"
            f" count(*) OVER (PARTITION BY grp) AS size FROM r{k})",
            f"s{k + 1} AS (SELECT s.doc_id, s.leaf, s.grp, {extra}s.pos // 16 AS pos,"
            f" CASE WHEN r.size = 1 THEN s.node ELSE sha256({left} || s.node || {right}) END AS node,"
            f" s.proof || CASE WHEN r.size = 1 THEN '' ELSE {left} || {right} END AS proof"
            f" FROM {rows} s JOIN r{k} r ON r.grp = s.grp AND r.run = s.pos // 16)",
        ]
    last = levels + top_levels
    return (
        ", ".join(steps)
        + " SELECT s.doc_id, s.leaf, t.subroot, n.digest AS root, sha256(s.proof) AS proof_sha256, s.node AS folded_root,"
        + f" s.node = n.digest AS verified FROM s{last} s JOIN subroots t USING (source_no) CROSS JOIN n{last} n"
    )


ORACLES: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op3_url_filter": OP3_SQL,
    "op6_decontaminate": OP6_SQL,
    "op7_near_duplicates": OP7_SQL,
    "op8_mix_sources": OP8_SQL,
    "op10_suffix_dedup": OP10_SQL,
    "op12_merkle": _merkle_sql(),
}
