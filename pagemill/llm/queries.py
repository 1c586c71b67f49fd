"""The registered queries of this package, by name; SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import batch_dedup, canonical_text, keep_together, lang_id, leakage, mixture, split_overlap, survivor, truncation
from pagemill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap.split_overlaps(table(spark, d, "dataset_manifest"), table(spark, d, "page_assets"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return split_overlap.overlap_report(table(spark, d, "dataset_manifest"), table(spark, d, "page_assets"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical_text.same_look_lines(table(spark, d, "teacher_predictions"), table(spark, d, "gold_lines"))


def p2_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every transcript of both tables in its one form, with its counts of mixed-script tokens and of
    whole-script confusables."""
    rows = [table(spark, d, t).select(F.lit(t).alias("table_name"), "ord", "transcript") for t in ("teacher_predictions", "gold_lines")]
    both = canonical_text.with_canonical(rows[0].unionByName(rows[1]))
    return both.select("table_name", "ord", "canonical", canonical_text.script_report_udf("transcript").alias("s")).select("table_name", "ord", "canonical", "s.mixed_tokens", "s.whole_script_tokens")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    preds = table(spark, d, "teacher_predictions")
    return lang_id.wrong_labels(preds, lang_id.fit(preds, "ord"))


def p3_languages(spark: SparkSession, d: str) -> DataFrame:
    preds = table(spark, d, "teacher_predictions")
    return lang_id.identify(preds, lang_id.fit(preds, "ord"), "ord", "transcript")


def p3_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return lang_id.identify(docs, lang_id.fit(docs, "doc_id", "text", **lang_id.DOCUMENTS), "doc_id", "text", enough=20)


def p3_decisions(spark: SparkSession, d: str) -> DataFrame:
    preds = table(spark, d, "teacher_predictions")
    return lang_id.decisions(preds, lang_id.fit(preds, "ord"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return batch_dedup.repeated(table(spark, d, "page_assets"))


def p4_repeats(spark: SparkSession, d: str) -> DataFrame:
    return batch_dedup.repeats(table(spark, d, "page_assets"))


def p4_index(spark: SparkSession, d: str) -> DataFrame:
    return batch_dedup.index_report(table(spark, d, "page_assets"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.best_rows(table(spark, d, "page_assets"))


def p5_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "page_assets"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return keep_together.divided(table(spark, d, "dataset_manifest"), table(spark, d, "page_assets"))


def p6_assignment(spark: SparkSession, d: str) -> DataFrame:
    return keep_together.keep_together(table(spark, d, "dataset_manifest"), table(spark, d, "page_assets"))


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    return keep_together.shares(table(spark, d, "dataset_manifest"), table(spark, d, "page_assets"))


def p6_pages(spark: SparkSession, d: str) -> DataFrame:
    return keep_together.assigned_pages(table(spark, d, "dataset_manifest"), table(spark, d, "page_assets"))


def p6_series(spark: SparkSession, d: str) -> DataFrame:
    """Per series its records and the number of splits it is assigned to."""
    placed = p6_assignment(spark, d).where("series_id is not null")
    return placed.groupBy("series_id").agg(F.sum("records").alias("records"), F.countDistinct("split").alias("splits"))


def p6_targets(spark: SparkSession, d: str) -> DataFrame:
    """Whether the share of each split is within a hundredth of its target."""
    return p6_shares(spark, d).select("split", (F.abs(F.col("share") - F.col("target")) <= 0.01).alias("kept"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leak_report(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixture_shares(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p8_targets(spark: SparkSession, d: str) -> DataFrame:
    return mixture.kept_targets(table(spark, d, "documents"), table(spark, d, "source_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents"))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.rates(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_canonical, p3_found, p3_languages, p3_documents, p3_decisions, p4_found, p4_repeats, p4_index, p5_found, p5_survivors, p6_found, p6_assignment, p6_shares, p6_pages, p6_series, p6_targets, p7_found, p7_report, p8_mixture, p8_shares, p8_targets, p9_found, p9_rates)}

_CODE = "CASE WHEN regexp_full_match(lower(trim(phash)), '[0-9a-f]{16}') AND lower(trim(phash)) NOT IN ('0000000000000000', 'ffffffffffffffff') THEN ('0x' || lower(trim(phash)))::UBIGINT END"
_SAME = "(a.sha = b.sha OR bit_count(xor(a.code, b.code)) <= 6)"



def _count(letters: str) -> str:
    return f"length(regexp_replace(coalesce(transcript, ''), '[^{letters}]', '', 'g'))"


_WIDE = "".join(chr(0xFF00 + ord(c) - 0x20) for c in "0123456789abcdefghijklmnopqrstuvwxyz")


def _letters(c: str) -> str:
    """Letters and digits in lower case, full-width ones in the usual width."""
    return f"regexp_replace(translate(lower(nfc_normalize({c})), '{_WIDE}', '0123456789abcdefghijklmnopqrstuvwxyz'), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


_JA = r"\x{3005}-\x{3007}\x{3041}-\x{3096}\x{309D}-\x{309F}\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{2F00}-\x{2FD5}\x{FF66}-\x{FF9D}"
_KO = r"\x{AC00}-\x{D7A3}\x{1100}-\x{1112}"  # a syllable in parts has one leading consonant
_LATIN = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}\x{FB00}-\x{FB06}" + "".join(f"\\x{{{ord(c):X}}}" for line in canonical_text._lines(canonical_text._LATIN) for c in line if not c.isascii())
_LABEL = "lower(trim(coalesce(lang, '')))"

#: SQL for the problems that SQL can express; it compares all pairs, so it is for small tables.
SQL: dict[str, str] = {
    "p1_found": f"""
        WITH paths AS (SELECT replace(image_path, '\\', '/') AS path, lower(trim(split)) AS split FROM dataset_manifest),
        side AS (SELECT path, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS t, max(CASE WHEN split IN ('val', 'test') THEN 1 ELSE 0 END) AS e
                 FROM paths WHERE split IN ('train', 'val', 'test') GROUP BY path),
        img AS (SELECT DISTINCT replace(image_path, '\\', '/') AS path, lower(trim(sha256)) AS sha, {_CODE} AS code FROM page_assets),
        k AS (SELECT side.path, t, e, sha, code FROM side JOIN img USING (path))
        SELECT DISTINCT least(a.path, b.path) AS image_path_a, greatest(a.path, b.path) AS image_path_b
        FROM k a JOIN k b ON a.t = 1 AND b.e = 1 AND {_SAME}""",
    "p1_report": f"""
        WITH paths AS (SELECT replace(image_path, '\\', '/') AS path, lower(trim(split)) AS split FROM dataset_manifest),
        img AS (SELECT DISTINCT replace(image_path, '\\', '/') AS path, lower(trim(sha256)) AS sha, {_CODE} AS code FROM page_assets),
        tr AS (SELECT DISTINCT sha, code FROM img JOIN paths USING (path) WHERE split = 'train'),
        leak AS (SELECT DISTINCT a.path FROM img a JOIN tr b ON {_SAME}),
        ev AS (SELECT DISTINCT path, split FROM paths JOIN img USING (path) WHERE split IN ('val', 'test')),
        src AS (SELECT DISTINCT replace(image_path, '\\', '/') AS path, source_id FROM page_assets)
        SELECT split, source_id, count(*) AS eval_pages, count(leak.path) AS leaked_pages FROM ev JOIN src USING (path) LEFT JOIN leak USING (path) GROUP BY split, source_id""",
    "p3_found": f"""
        WITH c AS (SELECT ord, CASE WHEN {_LABEL} IN ('jp', 'ja-jp') THEN 'ja' WHEN {_LABEL} IN ('kr', 'ko-kr') THEN 'ko' ELSE {_LABEL} END AS label,
                {_count(_JA)} AS ja, {_count(_KO)} AS ko, {_count(_LATIN)} + {_count(r"\x{FB00}-\x{FB06}")} AS latin FROM teacher_predictions),
        l AS (SELECT ord, label, unnest(['ja', 'ko', 'latin']) AS lang, unnest([ja, ko, latin]) AS n, greatest(ja, ko, latin) AS most FROM c),
        k AS (SELECT * FROM l WHERE n > 0 AND (n >= 4 OR (most < 4 AND n = most))),
        w AS (SELECT *, count(*) OVER (PARTITION BY ord) AS langs FROM k)
        SELECT ord, lang FROM w WHERE label <> CASE WHEN langs > 1 THEN 'mixed' ELSE lang END""",
    "p4_found": f"""
        WITH r AS (SELECT ord, coalesce(batch_id, 0) AS batch, lower(trim(sha256)) AS sha, {_CODE} AS code FROM page_assets)
        SELECT DISTINCT a.ord FROM r a JOIN r b ON a.batch >= 1 AND b.ord < a.ord AND {_SAME}""",
    "p4_repeats": f"""
        WITH r AS (SELECT ord, coalesce(batch_id, 0) AS batch, lower(trim(sha256)) AS sha, {_CODE} AS code FROM page_assets),
        m AS (SELECT a.ord, a.batch, min(CASE WHEN a.sha = b.sha THEN b.ord END) AS s, min(CASE WHEN a.code = b.code THEN b.ord END) AS c, min(CASE WHEN bit_count(xor(a.code, b.code)) <= 6 THEN b.ord END) AS n
              FROM r a LEFT JOIN r b ON b.ord < a.ord AND {_SAME} WHERE a.batch >= 1 GROUP BY a.ord, a.batch)
        SELECT ord, batch, coalesce(s, c, n) AS match_ord, CASE WHEN s IS NOT NULL THEN 'sha256' WHEN c IS NOT NULL THEN 'phash' WHEN n IS NOT NULL THEN 'near' ELSE 'new' END AS kind FROM m""",
    "p5_found": f"""
        WITH RECURSIVE r AS (SELECT ord, lower(trim(sha256)) AS sha, {_CODE} AS code, asset_id, nullif(trim(canonical_asset_id), '') AS canon,
                (phash IS NOT NULL)::INT + (width IS NOT NULL)::INT + (height IS NOT NULL)::INT AS present, coalesce(width::BIGINT * height::BIGINT, 0) AS area, fetched_at::TIMESTAMPTZ AS ts FROM page_assets),
        e AS (SELECT a.ord AS u, b.ord AS v FROM r a JOIN r b ON a.ord <> b.ord AND ({_SAME} OR a.asset_id = b.asset_id OR a.canon = b.asset_id OR b.canon = a.asset_id)),
        reach AS (SELECT u AS s, u AS t FROM e UNION SELECT reach.s, e.v FROM reach JOIN e ON e.u = reach.t),
        g AS (SELECT s AS ord, min(t) AS group_ord FROM reach GROUP BY s),
        f AS (SELECT group_ord, r.* FROM g JOIN r USING (ord)),
        m AS (SELECT group_ord, max(present) AS p, max(area) AS a, max(ts) AS t FROM f GROUP BY group_ord)
        SELECT group_ord, min(ord) AS best_ord FROM f JOIN m USING (group_ord) WHERE present = p AND area = a AND ts = t GROUP BY group_ord HAVING count(*) = 1""",
    "p6_found": """
        SELECT replace(lower(trim(series_id)), '_', '-') AS series_id FROM dataset_manifest
        WHERE lower(trim(split)) IN ('train', 'val', 'test') AND trim(series_id) <> ''
        GROUP BY 1 HAVING count(DISTINCT lower(trim(split))) > 1""",
    "p6_pages": "SELECT replace(image_path, '\\', '/') AS image_path, count(*) AS records, 1 AS splits FROM dataset_manifest WHERE image_path IS NOT NULL GROUP BY 1",
    "p6_series": "SELECT replace(lower(trim(series_id)), '_', '-') AS series_id, count(*) AS records, 1 AS splits FROM dataset_manifest WHERE trim(series_id) <> '' GROUP BY 1",
    "p6_targets": "SELECT unnest(['train', 'val', 'test']) AS split, true AS kept",
    "p7_found": f"""
        WITH i AS (SELECT item_id, {_letters("text")} AS t FROM eval_items), d AS (SELECT doc_id, {_letters("text")} AS t FROM documents),
        g AS (SELECT DISTINCT item_id, substr(t, k, 60) AS w FROM (SELECT item_id, t, unnest(range(1, length(t) - 58)) AS k FROM i WHERE length(t) >= 60)),
        h AS (SELECT doc_id, substr(t, k, 60) AS w FROM (SELECT doc_id, t, unnest(range(1, length(t) - 58)) AS k FROM d WHERE length(t) >= 60))
        SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (w)""",
    "p8_targets": """
        SELECT source, true AS share_kept, true AS cap_kept FROM source_targets t
        WHERE target_share > 0 AND max_repeats > 0 AND EXISTS (SELECT 1 FROM documents d WHERE d.source = t.source AND d.text <> '')""",
}
