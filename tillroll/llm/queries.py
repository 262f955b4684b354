"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bbit, bpe, bwt, exact, langid, lexical, manifest, merkle, mixing, paragraphs, pieces, toxicity, url_filters
from tillroll.llm.tables import ascii_lower, read


def _drawn(text: Column) -> Column:
    """24 bits of a hash that SQL has as well."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint")


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """All pages against lists made of them: hosts blocked, released and blocked again, parts of hosts
    allowed, single pages blocked. The tables have no days, so hashes of ids and patterns give them."""
    pages = read(spark, folder, "pages")
    start = F.lit("2020-01-01").cast("date")
    day = F.date_add(start, (_drawn(F.col("page_id").cast("string")) % 1461).cast("int"))
    captures = pages.select("page_id", "url", day.alias("fetched_on"))
    parts = pages.select(url_filters.host(F.col("url")).alias("host"), url_filters.path(F.col("url")).alias("path"))
    parts = parts.filter("host <> ''")
    whole = parts.select("host").distinct().select(F.col("host").alias("pattern"), _drawn(F.col("host")).alias("h"))
    section = F.concat("host", F.lit("/"), F.element_at("path", 1))
    section = parts.filter(F.size("path") > 0).select(section.alias("pattern")).distinct().withColumn("h", _drawn(F.col("pattern")))
    page = F.concat("host", F.lit("/"), F.array_join(F.slice("path", 1, 2), "/"))
    page = parts.filter(F.size("path") > 1).select(page.alias("pattern")).distinct().withColumn("h", _drawn(F.col("pattern")))

    def dated(rows: DataFrame, effect: str, days: int, action: str, condition: str) -> DataFrame:
        at = F.date_add(start, (F.col("h") % 700 + days).cast("int"))
        return rows.filter(condition).select("pattern", F.lit(effect).alias("effect"), at.alias("day"), F.lit(action).alias("action"))

    entries = (
        dated(whole, "block", 0, "add", "h % 3 <> 0")
        .union(dated(whole, "block", 300, "remove", "h % 2 = 0"))
        .union(dated(whole, "block", 500, "add", "h % 5 < 2"))
        .union(dated(section, "allow", 100, "add", "h % 4 = 0"))
        .union(dated(section, "allow", 600, "remove", "h % 8 = 0"))
        .union(dated(page, "block", 0, "add", "h % 7 = 0"))
    )
    return url_filters.filtered(captures, entries)


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compared(read(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    lexicon = toxicity.learn(docs, read(spark, folder, "labels").filter(~held_out).select("doc_id", "toxic"))
    found = toxicity.score(docs, lexicon)
    predicted = (F.col("score") >= 0.7).cast("int")
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "hits", "words")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    learned = docs.filter(~held_out).filter("doc_id IS NOT NULL").select("text", "lang")
    found = langid.detect(docs, langid.train(learned))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    docs = read(spark, folder, "documents")
    return pieces.round_trip(docs, pieces.read_model(spark))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bbit.near(read(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.groups(read(spark, folder, "documents"))


def op9_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.duplicates(read(spark, folder, "documents"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = bwt.removed(read(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.best(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.counts(read(spark, folder, "documents"), bpe.read_ranks(spark))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all rows; a fifth of the rows is then checked against a text in lower case."""
    docs = read(spark, folder, "documents")
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    values = [ascii_lower(F.col(c), null=None) if c == "text" else F.col(c) for c in manifest.COLUMNS]
    found = manifest.proofs(docs, carried={"changed": F.when(touched, manifest.leaf(values))})
    root = manifest.folded(F.coalesce("changed", "leaf"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", manifest.siblings_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_mixing,
        op3_fingerprints,
        op4_toxicity,
        op5_language_id,
        op6_pieces,
        op7_near_dedup,
        op8_exact_dedup,
        op9_paragraph_dedup,
        op10_suffix_dedup,
        op11_lexical_search,
        op12_token_counts,
        op13_manifest,
    )
}

def manifest_sql(levels: int = 6) -> str:
    """SQL that joins nodes level by level, for up to 16 ** ``levels`` rows of a source and sources."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def row(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, items: str, group: str) -> str:
        """``name``_k: the nodes of level k with the group, their place and how many the group has."""
        steps = [f"{name}_0 AS (SELECT {group} AS grp, place, many, hash FROM {items})"]
        for k in range(1, levels + 1):
            steps.append(
                f"{name}_{k} AS (SELECT grp, place // 16 AS place, (any_value(many) + 15) // 16 AS many, "
                f"CASE WHEN any_value(many) > 1 THEN sha256(string_agg(hash, '' ORDER BY place)) ELSE any_value(hash) END AS hash "
                f"FROM {name}_{k - 1} GROUP BY grp, place // 16)"
            )
        return ", ".join(steps)

    def path(name: str) -> str:
        """Per level the siblings left and right of an item's node; none where nothing is joined."""
        return ", ".join(
            f"{name}_p{k} AS (SELECT *, "
            f"coalesce(string_agg(hash, '' ORDER BY place) OVER (PARTITION BY grp, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(hash, '' ORDER BY place) OVER (PARTITION BY grp, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r "
            f"FROM {name}_{k})"
            for k in range(levels)
        )

    def joined(name: str, group: str, place: str) -> str:
        return " ".join(
            f"JOIN {name}_p{k} {name}{k} ON {name}{k}.grp IS NOT DISTINCT FROM {group} AND {name}{k}.place = {place} // {16**k}"
            for k in range(levels)
        )

    runs = [f"{name}{k}" for name in ("leaves", "tops") for k in range(levels)]
    proof = " || ".join(f"{run}.l || {run}.r" for run in runs)
    # Each step of the folding has a name, as it is used twice by its own test.
    folds, last = [], "start"
    for i, run in enumerate(runs):
        folds.append(f"f{i} AS (SELECT *, CASE WHEN {run}_many > 1 THEN sha256({run}_l || {last} || {run}_r) ELSE {last} END AS s{i} FROM {'base' if i == 0 else f'f{i - 1}'})")
        last = f"s{i}"
    sides = ", ".join(f"{run}.l AS {run}_l, {run}.r AS {run}_r, {run}.many AS {run}_many" for run in runs)
    crc = (
        "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT), lambda crc, c: "
        "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, c)), 4294967295), 4294967295)"
    )
    return f"""
        WITH numbered AS (
            SELECT doc_id, source, {row("text")} AS hash,
                   CASE WHEN {crc} % 5 = 0 THEN {row(lower)} END AS changed
            FROM documents
        ), items AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, hash) - 1 AS place, count(*) OVER (PARTITION BY source) AS many
            FROM numbered
        ), {tree("leaves", "items", "source")}, {path("leaves")},
        sources AS (
            SELECT grp AS source, hash, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place, count(*) OVER () AS many FROM leaves_{levels}
        ), {tree("tops", "sources", "0")}, {path("tops")},
        base AS (
            SELECT items.doc_id, items.hash AS leaf, sources.hash AS subroot, root.hash AS root,
                   sha256({proof}) AS proof_sha256, coalesce(items.changed, items.hash) AS start, {sides}
            FROM items JOIN sources ON sources.source IS NOT DISTINCT FROM items.source, tops_{levels} root
            {joined("leaves", "items.source", "items.place")} {joined("tops", "0", "sources.place")}
        ), {", ".join(folds)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, {last} AS folded_root, {last} = root AS verified FROM f{len(runs) - 1}"""


ORACLES = {
    "op1_url_filters": r"""
        WITH parsed AS (
            SELECT page_id, DATE '2020-01-01' + (('0x' || substr(md5(page_id::VARCHAR), 1, 6))::BIGINT % 1461)::INTEGER AS fetched_on,
                   regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', '') AS host,
                   list_filter(string_split(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS path
            FROM pages
        ), patterns AS (
            SELECT 1 AS parts, host AS pattern FROM parsed WHERE host <> ''
            UNION SELECT 2, host || '/' || path[1] FROM parsed WHERE host <> '' AND len(path) > 0
            UNION SELECT 3, host || '/' || path[1] || '/' || path[2] FROM parsed WHERE host <> '' AND len(path) > 1
        ), hashed AS (
            SELECT *, ('0x' || substr(md5(pattern), 1, 6))::BIGINT AS h FROM patterns
        ), entries AS (
            SELECT pattern, 'block' AS effect, h % 700 AS day, 1 AS added FROM hashed WHERE (parts = 1 AND h % 3 <> 0) OR (parts = 3 AND h % 7 = 0)
            UNION ALL SELECT pattern, 'block', h % 700 + 300, 0 FROM hashed WHERE parts = 1 AND h % 2 = 0
            UNION ALL SELECT pattern, 'block', h % 700 + 500, 1 FROM hashed WHERE parts = 1 AND h % 5 < 2
            UNION ALL SELECT pattern, 'allow', h % 700 + 100, 1 FROM hashed WHERE parts = 2 AND h % 4 = 0
            UNION ALL SELECT pattern, 'allow', h % 700 + 600, 0 FROM hashed WHERE parts = 2 AND h % 8 = 0
        ), states AS (  -- the last entry of a pattern on or before the day of the fetch
            SELECT page_id, e.pattern, e.effect, max_by(e.added, e.day * 2 + e.added) AS state
            FROM parsed p JOIN entries e
              ON (p.host = e.pattern OR p.host || '/' || p.path[1] = e.pattern OR p.host || '/' || p.path[1] || '/' || p.path[2] = e.pattern)
             AND DATE '2020-01-01' + e.day::INTEGER <= p.fetched_on
            GROUP BY ALL
        ), top AS (
            SELECT page_id, count(*) AS active, max_by(pattern, len(pattern)) AS decided_by,
                   max_by(effect, len(pattern) * 2 + (effect = 'allow')::INTEGER) = 'block' AS blocked
            FROM states WHERE state = 1 GROUP BY page_id
        )
        SELECT page_id, host, fetched_on, coalesce(active, 0) AS active, decided_by, coalesce(blocked, false) AS blocked
        FROM parsed LEFT JOIN top USING (page_id)""",
    "op2_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5(doc_id::VARCHAR), 1, 9))::BIGINT AS h
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
            FROM sized GROUP BY source
        ), levels AS (  -- the source at which sharing stops, if those with less per weight are capped
            SELECT a.source_size / a.weight AS ratio,
                   (SELECT sum(source_size) FROM sources) - coalesce(sum(3 * b.source_size) FILTER (WHERE b.source_size / b.weight < a.source_size / a.weight), 0) AS rest,
                   sum(b.weight) FILTER (WHERE b.source_size / b.weight >= a.source_size / a.weight) AS rest_weight
            FROM sources a, sources b GROUP BY a.source, a.source_size, a.weight
        ), level AS (
            SELECT rest::BIGINT AS rest, rest_weight::BIGINT AS rest_weight FROM levels WHERE rest <= 3 * ratio * rest_weight ORDER BY ratio LIMIT 1
        ), planned AS (
            SELECT source, source_size,
                   CASE WHEN rest * weight > 3 * source_size * rest_weight THEN (3 * source_size)::DOUBLE
                        ELSE weight * rest::DOUBLE / rest_weight END AS target
            FROM sources, level
        ), budgets AS (
            SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS repeats FROM planned
        ), placed AS (
            SELECT s.*, source_size, target, repeats, target - repeats * source_size AS budget,
                   sum(size) OVER (PARTITION BY s.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
                   sum(size) OVER (PARTITION BY s.source, h) AS tied
            FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
        )
        SELECT doc_id, source, size, source_size, target,
               (size * (repeats + (CASE WHEN upto <= budget OR 2 * (budget - (upto - tied)) >= tied THEN 1 ELSE 0 END)))::BIGINT AS taken
        FROM placed""",
    "op7_near_dedup": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' '))) END AS grams
            FROM split
        ), grams AS (
            SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, a.n AS a_n, b.n AS b_n, count(*) AS both_have
            FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common WHERE 100 * both_have >= 75 * (a_n + b_n - both_have)
        ), edges AS (
            SELECT a AS v, b AS w FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT doc_id AS v, doc_id AS r FROM sets
            UNION
            SELECT edges.w, reached.r FROM reached JOIN edges USING (v)
        )
        SELECT doc_id, len(grams)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN (SELECT v AS doc_id, min(r) AS component_id FROM reached GROUP BY v) USING (doc_id)""",
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        WINDOW same AS (PARTITION BY norm)""",
    "op11_lexical_search": r"""
        WITH documents_terms AS (
            SELECT doc_id, list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                   lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
            FROM documents
        ), filled AS (
            SELECT doc_id, terms, len(terms)::BIGINT AS n FROM documents_terms WHERE len(terms) > 0
        ), totals AS (
            SELECT count(*)::BIGINT AS many, sum(n)::BIGINT AS length FROM filled
        ), item_terms AS (
            SELECT item_id, term, count(*)::BIGINT AS q
            FROM (
                SELECT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
                FROM benchmark
            )
            GROUP BY ALL
        ), counted AS (
            SELECT doc_id, n, term, count(*)::BIGINT AS tf
            FROM (SELECT doc_id, n, unnest(terms) AS term FROM filled)
            WHERE term IN (SELECT term FROM item_terms)
            GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * many + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
            FROM (SELECT term, count(*)::BIGINT AS df FROM counted GROUP BY term), totals
        ), scores AS (
            SELECT item_id, doc_id,
                   sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * many) // length))))::BIGINT AS score
            FROM item_terms JOIN weights USING (term) JOIN counted USING (term), totals
            GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 10""",
    "op13_manifest": manifest_sql(),
}
