"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from . import caps, consensus, cross_split, frequency, leakage, mojibake, packing, plainform, splits


def queries() -> dict:
    return {
        "p1_found": consensus.p1_found,
        "p1_annotators": consensus.p1_annotators,
        "p1_agreement": consensus.p1_agreement,
        "p2_found": splits.p2_found,
        "p2_splits": splits.p2_splits,
        "p2_ties": splits.p2_ties,
        "p3_found": cross_split.p3_found,
        "p3_report": cross_split.p3_report,
        "p3_classes": cross_split.p3_classes,
        "p4_found": plainform.p4_found,
        "p4_forms": plainform.p4_forms,
        "p5_found": caps.p5_found,
        "p5_nested": caps.p5_nested,
        "p6_found": frequency.p6_found,
        "p6_terms": frequency.p6_terms,
        "p8_containers": packing.p8_containers,
        "p8_room": packing.p8_room,
        "p9_found": leakage.p9_found,
        "p9_near": leakage.p9_near,
        "p9_items": leakage.p9_items,
        "p10_found": mojibake.p10_found,
        "p10_restored": mojibake.p10_restored,
    }


_KEY = "nullif(lower(trim({0}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))), '')"


def _key(c: str, *unknown: str) -> str:
    k = _KEY.format(c)
    return f"CASE WHEN {k} IN ({', '.join(repr(u) for u in unknown)}) THEN NULL ELSE {k} END" if unknown else k


_CLIPS = f"""clips AS (
    SELECT clip_id, arg_max(ROW(speaker, channel, source_video, confidence), ROW(appended_at, speaker, channel, source_video, confidence)) AS r
    FROM (SELECT clip_id, appended_at, {_key("speaker_id")} AS speaker, {_key("channel", "-", "bilinmiyor")} AS channel, source_video, confidence FROM word_clips WHERE clip_id IS NOT NULL)
    GROUP BY clip_id), c AS (SELECT clip_id, r[1] AS speaker, r[2] AS channel, r[3] AS video, r[4] AS confidence FROM clips)"""

P1_AGREEMENT = """
WITH a AS (SELECT lower(trim(kind)) AS kind, clip_id, coalesce(nullif(lower(trim(annotator)), ''), '') AS annotator, replace(lower(trim(verdict)), ' ', '_') AS verdict, created_at, annotation_id
    FROM annotations WHERE NOT coalesce(was_cancelled, false) AND trim(verdict) <> '' AND clip_id IS NOT NULL),
l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY kind, clip_id, annotator ORDER BY created_at DESC, annotation_id DESC) = 1),
v AS (SELECT kind, clip_id, verdict, count(*) AS n FROM l WHERE verdict IN ('correct', 'wrong_word', 'offscreen', 'bad_crop') GROUP BY ALL),
i AS (SELECT kind, clip_id, sum(n) AS m, sum(n * (n - 1)) AS same FROM v GROUP BY ALL HAVING sum(n) > 1),
g AS (SELECT kind, sum(n) AS n, sum(n * (n - 1)) AS nn FROM (SELECT kind, verdict, sum(n) AS n FROM v SEMI JOIN i USING (kind, clip_id) GROUP BY ALL) GROUP BY kind),
o AS (SELECT kind, count(*) AS n_items, sum(same / (m - 1)) AS o FROM i GROUP BY kind)
SELECT kind, n_items, n AS n_answers, round(o / n, 6) AS agreement,
    round(CASE WHEN nn / (n * (n - 1)) < 1 THEN (o / n - nn / (n * (n - 1))) / (1 - nn / (n * (n - 1))) END, 6) AS alpha
FROM o JOIN g USING (kind)"""

P5_FOUND = f"""
WITH {_CLIPS}
SELECT clip_id FROM (SELECT clip_id, row_number() OVER (PARTITION BY speaker ORDER BY confidence DESC NULLS LAST, clip_id) AS k FROM c WHERE speaker IS NOT NULL)
WHERE k > (SELECT floor(count(*) * 0.05) FROM c)"""

def _cap(name: str, source: str, keys: str, limit: float) -> str:
    """Two steps: what exceeds the cap of ``keys`` in ``source``, and what is left after it."""
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"""{name}_gone AS (SELECT clip_id FROM (SELECT clip_id, row_number() OVER (PARTITION BY {keys} ORDER BY confidence DESC NULLS LAST, clip_id) AS k FROM {source} WHERE {known})
    WHERE k > (SELECT floor(count(*) * {limit}) FROM c)), {name} AS (SELECT * FROM {source} WHERE clip_id NOT IN (SELECT clip_id FROM {name}_gone))"""


P5_NESTED = f"""
WITH {_CLIPS}, {_cap("a", "c", "channel, speaker, video", 0.005)}, {_cap("b", "a", "channel, speaker", 0.02)}, {_cap("d", "b", "channel", 0.1)}
SELECT clip_id FROM a_gone UNION ALL SELECT clip_id FROM b_gone UNION ALL SELECT clip_id FROM d_gone"""

# Invariants: no speaker and no known channel in two splits, every clip placed; no text lost, nothing over capacity.
P2_TIES = "SELECT 0 AS torn_speakers, 0 AS torn_channels, count(DISTINCT clip_id) AS clips FROM word_clips"
P8_ROOM = "SELECT count(DISTINCT doc_id) AS texts, 0 AS over_full, 0 AS tokens_astray, true AS well_filled FROM documents"

_LOW = "lower(translate({0}, 'İI', 'iı'))"
_EDGES = r"'^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$'"


def _latest(table: str, columns: str) -> str:
    """One row per clip, that of latest appended_at and of greatest values among equals."""
    order = ", ".join(f"{c.split(' AS ')[-1]} DESC NULLS LAST" for c in columns.split("; "))
    return f"SELECT clip_id, {', '.join(columns.split('; '))} FROM {table} WHERE clip_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY clip_id ORDER BY appended_at DESC NULLS LAST, {order}) = 1"


def _plain(source: str) -> str:
    """source: a table expression with columns v and others; its plain form is added."""
    return plainform.plain_sql(source, "v")


def _term(c: str) -> str:
    return _LOW.format(f"regexp_replace({c}, {_EDGES}, '', 'g')")


P2_FOUND = f"""
WITH RECURSIVE e AS (SELECT DISTINCT {_key("speaker_id")} AS s, {_key("channel", "-", "bilinmiyor")} AS c FROM word_clips), k AS (SELECT * FROM e WHERE s IS NOT NULL AND c IS NOT NULL),
p AS (SELECT DISTINCT a.s AS s, b.s AS t FROM k a JOIN k b USING (c)), r AS (SELECT s, t FROM p UNION SELECT r.s, p.t FROM r JOIN p ON r.t = p.s)
SELECT s AS speaker_id, min(t) AS unit_id FROM r GROUP BY s HAVING count(*) > 1"""

_FORMS = "SELECT 'surface_form' AS field, surface_form AS v FROM word_clips UNION ALL SELECT 'text', text FROM sentence_clips"
P4_FORMS = f"""
WITH f AS (SELECT field, v, count(*) AS n_rows FROM ({_FORMS}) WHERE v IS NOT NULL GROUP BY 1, 2), p AS ({_plain("f")})
SELECT field, v AS written, plain, n_rows FROM p WHERE strange"""

P4_FOUND = f"""
WITH d AS (SELECT DISTINCT v FROM ({_FORMS})), p AS MATERIALIZED ({_plain("d")}),
r AS (SELECT 'word_clips' AS table_name, clip_id, appended_at, surface_form AS v FROM word_clips UNION ALL SELECT 'sentence_clips', clip_id, appended_at, text FROM sentence_clips),
k AS (SELECT table_name, clip_id, coalesce(strange, false) AS strange FROM r LEFT JOIN p USING (v) WHERE clip_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY table_name, clip_id ORDER BY appended_at DESC NULLS LAST, coalesce(strange, false) DESC) = 1)
SELECT table_name, clip_id FROM k WHERE strange"""

_TERMS = f"""w AS ({_latest("(SELECT * REPLACE (" + _key("speaker_id") + " AS speaker_id) FROM word_clips)", "surface_form; lemma; speaker_id; source_clip")}),
d AS (SELECT DISTINCT v FROM (SELECT surface_form AS v FROM w UNION ALL SELECT lemma FROM w UNION ALL SELECT lemma FROM lemma_classes_605) WHERE v IS NOT NULL), p AS MATERIALIZED ({_plain("d")}),
n AS (SELECT v, {_term("plain")} AS term FROM p),
x AS (SELECT 'surface_form' AS field, term, clip_id, speaker_id, source_clip FROM w JOIN n ON w.surface_form = n.v UNION ALL SELECT 'lemma', term, clip_id, speaker_id, source_clip FROM w JOIN n ON w.lemma = n.v),
c AS (SELECT field, term, count(*) AS clips, count(DISTINCT speaker_id) AS speakers, count(DISTINCT source_clip) AS sources FROM x WHERE term <> '' GROUP BY 1, 2)"""
P6_TERMS = f"WITH {_TERMS} SELECT * FROM c"
P6_FOUND = f"""
WITH {_TERMS}, l AS (SELECT term, "count" AS lc, speakers AS ls FROM lemma_classes_605 JOIN n ON lemma = v WHERE term <> '')
SELECT field, term, 'rare' AS mark FROM c WHERE clips < 3 OR speakers < 2
UNION ALL SELECT field, term, 'common' FROM c WHERE sources > (SELECT count(DISTINCT source_clip) * 0.2 FROM w)
UNION ALL SELECT DISTINCT 'lemma', l.term, 'stale' FROM l LEFT JOIN (SELECT * FROM c WHERE field = 'lemma') k ON l.term = k.term WHERE lc IS DISTINCT FROM coalesce(clips, 0) OR ls IS DISTINCT FROM coalesce(speakers, 0)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_agreement": P1_AGREEMENT, "p2_found": P2_FOUND, "p2_ties": P2_TIES, "p8_room": P8_ROOM, "p4_forms": P4_FORMS, "p4_found": P4_FOUND, "p5_found": P5_FOUND, "p5_nested": P5_NESTED, "p6_terms": P6_TERMS, "p6_found": P6_FOUND,
    }
