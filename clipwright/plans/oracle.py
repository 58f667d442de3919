"""SQL that DuckDB runs on the same tables to check the registered queries."""

from __future__ import annotations

from . import extra

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(160)"


def _key(c: str, *unknown: str) -> str:
    k = f"nullif(lower(trim({c}, {_BLANKS})), '')"
    return f"CASE WHEN {k} IN ({', '.join(repr(u) for u in unknown)}) THEN NULL ELSE {k} END" if unknown else k


def _low(c: str) -> str:
    return f"lower(translate({c}, 'İI', 'iı'))"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')"


def _surface(c: str) -> str:
    return _low(_strip(c))


# The letters beyond ASCII a label may have.
_LATIN = "çğıöşüâîûÇĞİÖŞÜÂÎÛéèêëáàäóòôúùñßøåæœ"
_LABEL = f"(coalesce({_surface('surface_form')}, '') <> '' AND substr(surface_form, 1, 1) NOT IN ('''', '’'))"
_SUFFIX = "(substr(surface_form, 1, 1) IN ('''', '’') AND length(surface_form) > 1)"
_VOWELS = "aeıioöuüâîû"


def _syll(c: str) -> str:
    return f"(length({c}) - length(translate({c}, '{_VOWELS}', '')))"


W = f"""w AS (SELECT * REPLACE ({_key("speaker_id")} AS speaker_id, {_key("channel", "-", "bilinmiyor")} AS channel, lower(trim(split)) AS split),
    {_surface("surface_form")} AS surface, {_low("lemma")} AS lemma_cls FROM word_clips)"""
C = f"""{W}, c AS (SELECT clip_id, min(speaker_id) AS speaker_id, min(channel) AS channel, min(lemma) AS lemma, min(surface) AS surface, min(lemma_cls) AS lemma_cls, min(split) AS split,
    min(source_clip) AS source_clip, max(confidence) AS confidence, max(n_frames) AS n_frames FROM w WHERE clip_id IS NOT NULL GROUP BY clip_id)"""
S = f"""{W}, sp AS (SELECT source_clip, max(split) AS split FROM w WHERE split IN ('train', 'val', 'test') GROUP BY source_clip),
s AS (SELECT clip_id, max(word_spans) AS word_spans, max(n_frames) AS n_frames, max(source_clip) AS source_clip FROM sentence_clips WHERE clip_id IS NOT NULL GROUP BY clip_id),
sent AS (SELECT s.*, sp.split FROM s JOIN sp USING (source_clip))"""
_FMT = """[{"surface_form":"VARCHAR","lemma":"VARCHAR","start_sec":"DOUBLE","end_sec":"DOUBLE"}]"""
SPANS = f"""{S}, arr AS (SELECT clip_id, split, n_frames, from_json(word_spans, '{_FMT}') AS ws FROM sent WHERE json_valid(word_spans)),
spans AS (SELECT clip_id, split, n_frames, u.i - 1 AS pos, ws[u.i].surface_form AS surface_form, ws[u.i].lemma AS lemma, ws[u.i].start_sec AS start_sec, ws[u.i].end_sec AS end_sec
    FROM arr, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i) u)"""
V = f"v AS (SELECT DISTINCT labeling, class FROM (SELECT {_low('lemma')} AS class FROM lemma_classes_605), (VALUES ('surface'), ('lemma')) t(labeling) WHERE class <> '')"
Q = f"""{SPANS}, {V}, o AS (SELECT *, least(greatest(start_sec, 0), n_frames / 25) AS s2, least(greatest(end_sec, 0), n_frames / 25) AS e2 FROM spans WHERE {_LABEL}),
lab AS (SELECT 'surface' AS labeling, {_surface("surface_form")} AS class, * FROM o UNION ALL SELECT 'lemma', {_low("lemma")}, * FROM o),
q AS (SELECT class, labeling, split, clip_id, pos, round(s2, 3) AS start_sec, round(e2, 3) AS end_sec, least(round_even(s2 * 25, 0)::INT, n_frames - 1) AS start_frame,
    least(greatest(least(round_even(s2 * 25, 0)::INT, n_frames - 1) + 1, round_even(e2 * 25, 0)::INT), n_frames) AS end_frame, surface_form, s2 <> start_sec OR e2 <> end_sec AS clamped
    FROM lab SEMI JOIN v USING (labeling, class))"""
_NEG = """pos AS (SELECT DISTINCT labeling, class, split, clip_id FROM q WHERE split IN ('val', 'test')),
pool AS (SELECT DISTINCT split, clip_id FROM sent WHERE split IN ('val', 'test')),
g AS (SELECT labeling, class, h.split FROM (SELECT labeling, class FROM pos WHERE split = 'test' GROUP BY ALL HAVING count(*) >= 5) x, (VALUES ('val'), ('test')) h(split)),
cand AS (SELECT g.labeling, g.class, g.split, pool.clip_id FROM g JOIN pool USING (split) ANTI JOIN pos USING (labeling, class, split, clip_id)),
neg AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY labeling, class, split ORDER BY md5('2026#' || clip_id), clip_id) <= 10)"""
VD = f"""a AS (SELECT lower(trim(kind)) AS kind, clip_id, {_key("annotator")} AS annotator, replace(lower(trim(verdict)), ' ', '_') AS verdict, created_at, annotation_id
    FROM annotations WHERE NOT coalesce(was_cancelled, false)),
vd AS (SELECT kind, clip_id, annotator, verdict FROM a WHERE verdict <> '' AND annotator IS NOT NULL QUALIFY row_number() OVER (PARTITION BY kind, clip_id, annotator ORDER BY created_at DESC, annotation_id DESC) = 1),
pairs AS (SELECT x.kind, x.clip_id, x.annotator AS a, y.annotator AS b, x.verdict AS va, y.verdict AS vb FROM vd x JOIN vd y ON x.kind = y.kind AND x.clip_id = y.clip_id AND x.annotator < y.annotator)"""
R = f"""r AS (SELECT clip_file, min(source_url) AS source_url, min(source_video) AS source_video, min(start_sec) AS start_sec, min(end_sec) AS end_sec, max(face_height_px) AS face_height_px,
    min({_key("reporter")}) AS reporter, max(duration_sec) AS duration_sec FROM reporter_clips WHERE clip_file IS NOT NULL GROUP BY clip_file)"""
E = "e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events)"
F = f"{E}, f AS (SELECT user_id, event_id, k, value, CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END AS status FROM e)"
_ID = r"coalesce(nullif(regexp_extract({0}, '(?:youtu\.be|kisa\.example)/([A-Za-z0-9_-]{{11}})', 1), ''), nullif(regexp_extract({0}, '[?&]v=([A-Za-z0-9_-]{{11}})', 1), ''), nullif(regexp_extract({0}, '/shorts/([A-Za-z0-9_-]{{11}})', 1), ''))"
URL = r"""h AS (SELECT *, string_split(trim(source_url), '#')[1] AS bare FROM @SOURCE), q AS (SELECT *, string_split(bare, '?')[1] AS front, substr(bare, length(string_split(bare, '?')[1]) + 2) AS query FROM h),
a AS (SELECT *, CASE WHEN contains(front, '://') THEN string_split(front, '://')[1] ELSE '' END AS scheme, CASE WHEN contains(front, '://') THEN substr(front, strpos(front, '://') + 3) ELSE front END AS rest FROM q),
p AS (SELECT *, CASE WHEN scheme <> '' THEN replace(replace(lower(string_split(rest, '/')[1]), 'www.', ''), 'm.', '') ELSE '' END AS host, CASE WHEN scheme <> '' THEN substr(rest, length(string_split(rest, '/')[1]) + 1) ELSE rest END AS path FROM a),
urls AS (SELECT *, CASE WHEN host IN ('youtu.be', 'kisa.example') AND trim(path, '/') <> '' THEN 'https://' || CASE host WHEN 'youtu.be' THEN 'youtube.com' ELSE 'video.example' END || '/watch?v=' || ltrim(rtrim(path, '/'), '/')
    WHEN host IN ('youtube.com', 'video.example', 'youtu.be', 'kisa.example') AND rtrim(path, '/') = '/watch' AND regexp_matches(query, '(^|&)v=[^&]') THEN 'https://' || host || '/watch?v=' || regexp_extract(query, '(?:^|&)v=([^&]+)', 1)
    WHEN host IN ('youtube.com', 'video.example') AND regexp_matches(path, '^/shorts/[^/]') THEN 'https://' || host || '/shorts/' || string_split(path, '/')[3] ELSE lower(scheme) || '://' || host || path END AS url FROM p)"""

_VOCAB = """SELECT class, train_n, val_n, test_n, n_speakers, n_channels FROM (SELECT {0} AS class, count(*) FILTER (split = 'train') AS train_n, count(*) FILTER (split = 'val') AS val_n,
    count(*) FILTER (split = 'test') AS test_n, count(DISTINCT speaker_id) FILTER (split = 'train') AS n_speakers, count(DISTINCT channel) FILTER (split = 'train') AS n_channels FROM w WHERE {1} GROUP BY 1)"""
_RULES = {
    "no_label": f"NOT coalesce({_LABEL}, false)",
    "track_gap": "coalesce(track_ok, 0) <> 1",
    "too_few_frames": "n_frames < 9",
    "word_too_short": "word_end_sec - word_start_sec < 0.04",
    "word_too_long": "word_end_sec - word_start_sec > 2.0",
}


def _chain(rules: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in rules.items()) + " END"


_ROLES = _chain(_RULES)
_SPAN0 = "round_even(({0}) * 25, 0)::INT"
_GATE = _chain({
    "empty_label": f"coalesce({_strip('surface_form')}, '') = ''", "suffix_fragment": _SUFFIX,
    "non_latin_label": rf"regexp_matches(regexp_replace(surface_form, '[\x00-\x7F{_LATIN}]', '', 'g'), '\p{{L}}')",
    "word_too_long": "word_end_sec - word_start_sec > 2.0",
    "out_of_range": f"NOT coalesce(greatest({_SPAN0.format('word_start_sec - clip_start_sec')}, 0) < least(greatest({_SPAN0.format('word_end_sec - clip_start_sec')}, {_SPAN0.format('word_start_sec - clip_start_sec')} + 1), n_frames), false)",
    "track_fail": "NOT coalesce(track_ok = 1, false)", "offscreen_speech": "word_sync_conf < 2.5 OR lip_motion < 0.05",
})

_COLUMNS = (
    "clip_id npz_path frame_start frame_end speaker_id channel source_clip source_video face_height_px mouth_width_px clip_start_sec clip_end_sec n_frames fps syncnet_score syncnet_offset lip_motion "
    "mean_yaw mean_pitch surface_form lemma word_start_sec word_end_sec confidence manual_review word_sync_conf track_ok split appended_at"
).split()
_SWEEP = " UNION ALL ".join(
    f"SELECT {k * 0.5} AS threshold, round(avg((word_sync_conf >= {k * 0.5})::INT::DOUBLE) FILTER (p), 6) AS tpr, round(avg((word_sync_conf >= {k * 0.5})::INT::DOUBLE) FILTER (NOT p), 6) AS fpr FROM t" for k in range(13)
)
_FALL = f"CASE WHEN translate({_surface('surface')}, 'âîûÂÎÛ', 'aiuAİU') = '' THEN surface ELSE translate({_surface('surface')}, 'âîûÂÎÛ', 'aiuAİU') END"
_SPK = f"SELECT DISTINCT {_key('speaker_id')} AS speaker_id FROM {{0}} WHERE {_key('speaker_id')} IS NOT NULL"

SQL: dict[str, str] = {
    "token_classes": rf"""WITH {W} SELECT surface AS class, count(*) AS n, count(*) FILTER ({_LABEL}) AS labelled, count(*) FILTER ({_SUFFIX}) AS suffixes,
        count(*) FILTER (NOT regexp_matches(regexp_replace(surface_form, '[\x00-\x7F{_LATIN}]', '', 'g'), '\p{{L}}')) AS latin, count(*) FILTER (regexp_matches(surface_form, '\p{{Nd}}')) AS digits,
        max({_syll("surface")}) AS syllables FROM w GROUP BY 1""",
    "vocab_surface": rf"WITH {W} {_VOCAB.format('surface', _LABEL)} WHERE train_n >= 10 AND n_speakers >= 3 AND NOT regexp_matches(class, '\p{{Nd}}')",
    "vocab_lemma": rf"WITH {W} {_VOCAB.format('lemma_cls', _LABEL)} WHERE train_n >= 10 AND n_speakers >= 3 AND NOT regexp_matches(class, '\p{{Nd}}')",
    "vocab_removals": rf"""WITH {W} SELECT CASE WHEN train_n < 10 THEN 'min_train' WHEN n_speakers < 3 THEN 'min_speakers' WHEN regexp_matches(class, '\p{{Nd}}') THEN 'digit'
        WHEN class IN ('ve', 'bir', 'bu') THEN 'stoplist' ELSE 'kept' END AS step, count(*) AS classes FROM ({_VOCAB.format('surface', _LABEL)}) GROUP BY 1""",
    "class_split_dense": f"""WITH {W}, {V} SELECT g.class, g.split, coalesce(k.n, 0) AS n FROM (SELECT * FROM (SELECT DISTINCT class FROM v), (VALUES ('train'), ('val'), ('test')) t(split)) g
        LEFT JOIN (SELECT lemma_cls AS class, split, count(*) AS n FROM w GROUP BY ALL) k ON g.class = k.class AND g.split = k.split""",
    "in_vocab_flags": f"WITH {W}, {V} SELECT split, (lemma_cls IS NOT NULL AND lemma_cls IN (SELECT class FROM v))::INT AS in_vocab_lemma, count(*) AS n FROM w GROUP BY ALL",
    "top_share": f"WITH {W}, p AS (SELECT lemma_cls AS class, speaker_id, count(*) AS n FROM w WHERE speaker_id IS NOT NULL GROUP BY ALL) SELECT class, sum(n)::BIGINT AS n, round(max(n) / sum(n), 6) AS top_share FROM p GROUP BY class",
    "class_ranks": f'SELECT *, row_number() OVER (ORDER BY "count" DESC, lemma) AS rank FROM (SELECT {_low("lemma")} AS lemma, max("count") AS "count" FROM lemma_classes_605 GROUP BY 1)',
    "quality_rules": " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) FILTER ({v}) AS standalone, count(*) FILTER ({_ROLES} = '{k}') AS first FROM word_clips" for k, v in _RULES.items()),
    "quality_reasons": f"WITH {W} SELECT split, {_ROLES} AS reason, count(*) AS n FROM w GROUP BY ALL",
    "small_faces": f"WITH {W} SELECT split, round(avg(coalesce(face_height_px < 150, false)::INT), 6) AS below_150, round(avg(coalesce(face_height_px < 220, false)::INT), 6) AS below_220 FROM w GROUP BY split",
    "empty_profile": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR {c}::VARCHAR = '') AS empty FROM word_clips" for c in _COLUMNS),
    "item_checks": r"""SELECT 'fps' AS check_name, count(*) FILTER (NOT coalesce(fps = 25, false)) AS violations FROM word_clips UNION ALL SELECT 'span', count(*) FILTER (frame_end - frame_start <> n_frames) FROM word_clips
        UNION ALL SELECT 'n_frames', count(*) FILTER (NOT coalesce(n_frames > 0, false)) FROM word_clips UNION ALL SELECT 'speaker', count(*) FILTER (coalesce(trim(speaker_id), '') = '') FROM word_clips
        UNION ALL SELECT 'channel', count(*) FILTER (coalesce(trim(channel), '') = '') FROM word_clips UNION ALL SELECT 'path', count(*) FILTER (instr(npz_path, '\') > 0) FROM word_clips
        UNION ALL SELECT 'unique', coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM word_clips GROUP BY clip_id HAVING count(*) > 1)""",
    "channel_leak": f"WITH {W} SELECT channel, count(*) AS n, count(*) FILTER (split = 'train' AND channel IN (SELECT channel FROM w WHERE split = 'test' AND channel IS NOT NULL)) AS leaked FROM w GROUP BY channel",
    "lemma_fallbacks": f"SELECT surface, {_FALL} AS lemma FROM (SELECT DISTINCT surface_form AS surface FROM word_clips WHERE surface_form IS NOT NULL)",
    "lemma_backfill": f"SELECT coalesce({_FALL}, lemma) IS DISTINCT FROM lemma AS changed, count(*) AS n FROM (SELECT surface_form AS surface, lemma FROM word_clips) GROUP BY 1",
    "lemma_choice": """SELECT surface, lemma FROM (SELECT surface_form AS surface, lemma, count(*) AS votes FROM word_clips WHERE surface_form IS NOT NULL AND lemma IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY surface ORDER BY length(lemma) % 2, length(lemma) % 3, regexp_matches(lemma, '[ae]') DESC, starts_with(surface, substr(lemma, 1, 2)) DESC, votes DESC, length(lemma) DESC, ascii(lemma), lemma) = 1""",
    "train_cap": f"""WITH {C}, t AS (SELECT * FROM c WHERE split = 'train'), lim AS (SELECT floor(count(*) * 0.05) AS l FROM t),
        big AS (SELECT speaker_id, count(*) AS n FROM t WHERE speaker_id IS NOT NULL GROUP BY 1 HAVING count(*) > (SELECT l FROM lim)),
        k AS (SELECT t.*, row_number() OVER (PARTITION BY speaker_id, lemma_cls ORDER BY md5('2026#' || clip_id), clip_id) AS rn, count(*) OVER (PARTITION BY speaker_id, lemma_cls) AS m, n, l FROM t JOIN big USING (speaker_id), lim)
        SELECT clip_id, speaker_id, lemma_cls FROM k WHERE rn > round_even(l / n * m, 0)""",
    "stratified_sample": f"""WITH {C}, k AS (SELECT clip_id, split, speaker_id, row_number() OVER (PARTITION BY split, speaker_id ORDER BY md5('2026#' || clip_id), clip_id) AS rn, count(*) OVER (PARTITION BY split, speaker_id) AS n FROM c)
        SELECT clip_id, split, speaker_id FROM k WHERE rn <= round_even(n * 0.05, 0)""",
    "annotator_assignment": f"""WITH {C}, k AS (SELECT clip_id, row_number() OVER (ORDER BY md5('2026#' || clip_id), clip_id) AS rn, round_even(count(*) OVER () * 0.1, 0) AS b FROM c)
        SELECT clip_id, CASE WHEN rn <= b THEN 'both' WHEN (rn - b)::BIGINT % 2 = 1 THEN 'a' ELSE 'b' END AS annotator FROM k""",
    "per_class_sample": f"WITH {C} SELECT clip_id, lemma_cls FROM c QUALIFY row_number() OVER (PARTITION BY lemma_cls ORDER BY md5('2026#' || clip_id), clip_id) <= 20",
    "global_sample": f"WITH {C} SELECT clip_id FROM c ORDER BY md5('2026#' || clip_id), clip_id LIMIT 500",
    "round_robin": f"""WITH {C} SELECT clip_id, speaker_id, turn FROM (SELECT clip_id, speaker_id, row_number() OVER (PARTITION BY speaker_id ORDER BY md5('2026#' || clip_id), clip_id) AS turn FROM c WHERE speaker_id IS NOT NULL)
        ORDER BY turn, speaker_id LIMIT 200""",
    "rank_slice": f"WITH {W}, k AS (SELECT lemma_cls, count(*) AS n FROM w WHERE lemma_cls IS NOT NULL GROUP BY 1) SELECT * FROM (SELECT *, row_number() OVER (ORDER BY n DESC, lemma_cls) AS rank FROM k) WHERE rank BETWEEN 40 AND 60",
    "rarest_classes": f"WITH {W} SELECT lemma_cls, count(*) AS n FROM w WHERE lemma_cls IS NOT NULL GROUP BY 1 ORDER BY n, lemma_cls DESC LIMIT 5",
    "interleaved": """SELECT o_orderkey, round(coalesce(sum(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 2) AS due FROM orders""",
    "spotting_queries": f"WITH {Q} SELECT class, labeling, split, clip_id, start_sec, end_sec, start_frame, end_frame, surface_form FROM q",
    "spotting_negatives": f"WITH {Q}, {_NEG} SELECT labeling, class, split, clip_id FROM neg",
    "spotting_classes": f"""WITH {Q}, {_NEG}, n AS (SELECT labeling, class, count(*) FILTER (split = 'val') AS vo, count(*) FILTER (split = 'test') AS tocc, count(DISTINCT clip_id) FILTER (split = 'val') AS vp,
        count(DISTINCT clip_id) FILTER (split = 'test') AS tp FROM q GROUP BY ALL), m AS (SELECT count(*) FILTER (split = 'val') AS vn, count(*) FILTER (split = 'test') AS tn FROM pool)
        SELECT labeling, class, coalesce(vo, 0) AS val_occurrences, coalesce(tocc, 0) AS test_occurrences, coalesce(vp, 0) AS val_pos_sentences, coalesce(tp, 0) AS test_pos_sentences,
        vn - coalesce(vp, 0) AS val_neg_sentences, tn - coalesce(tp, 0) AS test_neg_sentences, (coalesce(tp, 0) >= 5)::INT AS evaluable FROM v LEFT JOIN n USING (labeling, class) CROSS JOIN m""",
    "spotting_clamped": f"WITH {Q} SELECT count(*) AS clamped FROM (SELECT DISTINCT clip_id, pos FROM q WHERE clamped)",
    "occurrence_labels": f"WITH {Q} SELECT clip_id, start_sec, end_sec, surface_form, array_to_string(list_sort(list(DISTINCT labeling || ':' || class)), ' / ') AS labels FROM q GROUP BY ALL",
    "annotation_tasks": f"WITH {C} SELECT clip_id, to_json({{'data': {{'clip_id': clip_id, 'split': split, 'surface': surface}}}})::VARCHAR AS task FROM c WHERE split = 'test'",
    "recent_rates": """WITH r AS (SELECT user_id, epoch_us(ts) / 1000000 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
        SELECT user_id, round(CASE WHEN max(s) > min(s) THEN (count(*) - 1) * 3600 / (max(s) - min(s)) END, 4) AS overall,
        round(CASE WHEN max(s) > min(s) FILTER (rn <= 6) THEN (count(*) FILTER (rn <= 6) - 1) * 3600 / (max(s) - min(s) FILTER (rn <= 6)) END, 4) AS recent FROM r GROUP BY user_id""",
    "idle_users": "SELECT user_id, epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(ts)) > 86400000000 AS idle FROM events GROUP BY user_id",
    "broken_spans": "SELECT count(*) AS rows, count(*) FILTER (word_spans IS NULL OR NOT json_valid(word_spans)) AS broken FROM sentence_clips",
    "track_islands": """WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS solo FROM events), p AS (SELECT *, lag(solo) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM e),
        t AS (SELECT *, sum((solo IS NULL OR prev IS NULL OR abs(solo - prev) >= 5)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS track FROM p)
        SELECT user_id, track::BIGINT AS track, count(*) AS n, min(ts) AS start, max(ts) AS "end", round(quantile_cont(solo, 0.5), 6) AS median FROM t WHERE solo IS NOT NULL GROUP BY user_id, track""",
    "forward_filled": """WITH e AS (SELECT *, CASE WHEN event_type = 'click' THEN value END AS c FROM events)
        SELECT event_id, coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), -1.0) AS forward,
        first_value(c IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward FROM e""",
    "centred_stats": """SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS mean5,
        round(quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING), 6) AS median13 FROM events""",
    "median_filtered": """WITH e AS (SELECT event_id, list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS xs FROM events)
        SELECT event_id, list_sort(list_concat(list_transform(xs, lambda x: coalesce(x, 0.0)), list_transform(range(9 - len(xs)), lambda x: 0.0::DOUBLE)))[5] AS filtered FROM e""",
    "short_holes_filled": f"""WITH {F}, g AS (SELECT *, sum((p IS NULL OR p <> status)::INT) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY k) AS p FROM f)),
        r AS (SELECT user_id, run, min(status) AS status, count(*) AS n FROM g GROUP BY ALL), x AS (SELECT *, lag(status) OVER w AS l, lead(status) OVER w AS rr FROM r WINDOW w AS (PARTITION BY user_id ORDER BY run)),
        y AS (SELECT user_id, CASE WHEN status = 1 AND n <= 2 AND l = 0 AND rr = 0 THEN 0 ELSE status END AS status, n FROM x) SELECT user_id, status, sum(n)::BIGINT AS n FROM y GROUP BY user_id, status""",
    "spread_counts": f"""WITH {F}, h AS (SELECT *, CASE WHEN k % 5 = 0 THEN CASE WHEN value > 20 THEN 2 ELSE 1 END END AS heads FROM f),
        s AS (SELECT *, coalesce(last_value(heads IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING), 1) AS a,
        coalesce(first_value(heads IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1) AS b FROM h)
        SELECT user_id, CASE WHEN status = 0 AND (a > 1 OR b > 1) THEN 9 ELSE status END AS status, count(*) AS n FROM s GROUP BY 1, 2""",
    "jumps": f"""WITH {F}, r AS (SELECT *, last_value(CASE WHEN status = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ref FROM f)
        SELECT event_id, coalesce(sqrt((value - ref) * (value - ref) + (value - ref) * (value - ref) / 4) > ref % 7 + 3, false) AS jump FROM r""",
    "smoothed": f"""WITH {F}, g AS (SELECT *, CASE WHEN status = 0 THEN value END AS g FROM f),
        a AS (SELECT *, avg(g) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m, quantile_cont(g, 0.5) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS d,
        first_value(g IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS first_seen FROM g)
        SELECT event_id, round(coalesce(last_value(m IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING), first_seen, 0), 6) AS mean,
        round(coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING), first_seen, 0), 6) AS median FROM a""",
    "padded_windows": f"""WITH {F}, b AS (SELECT user_id, k, status, max(CASE WHEN status <> 0 THEN k END) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS lb,
        min(CASE WHEN status <> 0 THEN k END) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nb, max(k) OVER (PARTITION BY user_id) + 1 AS t FROM f),
        x AS (SELECT user_id, k AS f0, greatest(k - 15, 0) AS w0, least(k + 16, t) AS w1, coalesce(lb, -1) + 1 AS l, coalesce(nb, t) AS r FROM b WHERE status = 0)
        SELECT user_id, f0, greatest(w0, l) AS a, least(w1, r) AS b, l <= w0 AND r >= w1 AS full_pad FROM x""",
    "pauses": f"WITH {SPANS} SELECT clip_id, pos, round(lead(start_sec) OVER (PARTITION BY clip_id ORDER BY pos) - end_sec, 6) AS pause FROM spans",
    "last_session": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events), g AS (SELECT *, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 86400000000, false) AS gap FROM r WHERE rn <= 400),
        t AS (SELECT *, coalesce(sum(gap::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS tail FROM g) SELECT user_id, count(*) AS n, min(ts) AS since FROM t WHERE tail = 0 GROUP BY user_id""",
    "change_points": """SELECT user_id, count(*) FILTER (c) AS changes, count(*) AS n FROM (SELECT user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type AS c FROM events) GROUP BY user_id""",
    "chunk_tiles": "SELECT source_clip, floor(word_start_sec / 5)::BIGINT AS chunk, count(*) AS n FROM word_clips GROUP BY ALL",
    "sessions": """WITH g AS (SELECT user_id, epoch_us(ts) AS t, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 21600000000, true) AS s FROM events),
        i AS (SELECT *, sum(s::INT) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(t) AS start_us, max(t) + 21600000000 AS end_us, count(*) AS n FROM i GROUP BY user_id, k""",
    "hourly_counts": "SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS n FROM events GROUP BY ALL",
    "streamed_words": "SELECT split, count(*) AS n FROM word_clips WHERE source_clip IS NOT NULL GROUP BY split",
    "queue_selection": f"SELECT speaker_id AS reporter, {_key('speaker_id')} AS row_pos FROM speaker_table WHERE coalesce(trim(speaker_id), '') <> 'spk_0000001' ORDER BY row_pos NULLS FIRST LIMIT 50",
    "greedy_overlap": f"""WITH {R}, {URL.replace("@SOURCE", "r")}, x AS (SELECT url, list({{'pos': clip_file, 's': start_sec, 'e': end_sec, 'kept': true}} ORDER BY clip_file) AS xs FROM urls GROUP BY url),
        y AS (SELECT list_reduce(list_transform(xs, lambda x: [x]), lambda acc, x: list_concat(acc, [{{'pos': x[1].pos, 's': x[1].s, 'e': x[1].e,
            'kept': len(list_filter(acc, lambda k: k.kept AND (k.s IS NULL OR k.e IS NULL OR coalesce(least(k.e, x[1].e) - greatest(k.s, x[1].s) >= 1.0, false)))) = 0}}])) AS zs FROM x)
        SELECT z.pos AS clip_file, z.kept AS kept FROM (SELECT unnest(zs) AS z FROM y)""",
    "merged_speakers": f"SELECT * FROM ({_SPK.format('speaker_table')}) UNION SELECT * FROM ({_SPK.format('word_clips')})",
    "merge_counts": f"""WITH n AS (SELECT count(*) AS n, count({_key("speaker_id")}) AS known FROM word_clips), x AS (SELECT count(*) AS added FROM (({_SPK.format('word_clips')}) EXCEPT ({_SPK.format('speaker_table')})))
        SELECT added, known - added AS duplicates, n - known AS unparseable FROM n, x""",
    "zero_clip_rows": f"SELECT speaker_id FROM speaker_table WHERE {_key('speaker_id')} NOT IN (SELECT {_key('reporter')} FROM reporter_clips WHERE {_key('reporter')} IS NOT NULL)",
    "stable_order": "SELECT o_orderkey, b::INT AS bucket, row_number() OVER (ORDER BY b, o_orderkey) AS new_pos FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS b FROM orders)",
    "budget_stop": """SELECT o_orderkey FROM (SELECT o_orderkey, coalesce(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS h FROM orders) WHERE h < 500000""",
    "channel_enrichment": f"""WITH {R}, {W}, l AS (SELECT regexp_replace(source_video, '\\.[^.]*$', '') AS vid, channel, clip_id FROM w WHERE channel IS NOT NULL),
        k AS (SELECT {_ID.format("('https://video.example/watch?v=' || vid)")} AS ident, arg_min(channel, clip_id) AS channel FROM l GROUP BY 1),
        x AS (SELECT clip_file, {_ID.format("source_url")} AS ident FROM r) SELECT coalesce(channel, '') AS channel, count(*) AS n FROM x LEFT JOIN k USING (ident) GROUP BY 1""",
    "height_classes": f"""WITH {R}, c AS (SELECT source_video, max(face_height_px) AS h FROM r WHERE face_height_px IS NOT NULL GROUP BY 1)
        SELECT CASE WHEN h IS NULL THEN 'unknown' WHEN h < 300 THEN 'low' ELSE 'ok' END AS height_class, count(*) AS n FROM r LEFT JOIN c USING (source_video) GROUP BY 1""",
    "pending_sources": "SELECT DISTINCT source_clip FROM word_clips WHERE source_clip IS NOT NULL AND source_clip NOT IN (SELECT clip_file FROM reporter_clips WHERE clip_file IS NOT NULL)",
    "committed_rows": f"WITH {W} SELECT split, count(*) AS n FROM w WHERE source_clip IN (SELECT clip_file FROM reporter_clips WHERE clip_file IS NOT NULL) GROUP BY split",
    "journal_replay": """WITH c AS (SELECT DISTINCT clip_id FROM word_clips WHERE clip_id IS NOT NULL), v AS (SELECT clip_id, max(verified) AS ok FROM verified WHERE clip_id IS NOT NULL GROUP BY 1)
        SELECT c.clip_id FROM c ANTI JOIN v USING (clip_id) UNION ALL SELECT clip_id || x FROM (SELECT c.clip_id FROM c JOIN v USING (clip_id) WHERE ok = 1), (VALUES ('_a'), ('_b')) t(x)""",
    "orphan_files": "SELECT DISTINCT clip_file AS path FROM reporter_clips WHERE clip_file IS NOT NULL AND clip_file NOT IN (SELECT source_clip FROM word_clips WHERE source_clip IS NOT NULL)",
    "segment_validation": f"""WITH {R}, x AS (SELECT start_sec AS s, CASE WHEN duration_sec > 4 THEN end_sec END AS e FROM r)
        SELECT CASE WHEN (s IS NULL) <> (e IS NULL) THEN 'one_bound_missing' WHEN e <= s THEN 'end_not_after_start' END AS reason, count(*) AS n FROM x GROUP BY 1""",
    "kappa": f"""WITH {VD}, cell AS (SELECT kind, a, b, va, vb, count(*) AS n FROM pairs GROUP BY ALL), t AS (SELECT kind, a, b, sum(n)::BIGINT AS n, sum(CASE WHEN va = vb THEN n ELSE 0 END) AS same FROM cell GROUP BY ALL),
        rr AS (SELECT kind, a, b, va AS v, sum(n) AS r FROM cell GROUP BY ALL), cc AS (SELECT kind, a, b, vb AS v, sum(n) AS c FROM cell GROUP BY ALL),
        m AS (SELECT kind, a, b, sum(coalesce(r, 0) * coalesce(c, 0)) AS rc, count(*) AS labels FROM rr FULL JOIN cc USING (kind, a, b, v) GROUP BY ALL)
        SELECT kind, a, b, n, round(same / n, 6) AS agreement, round(CASE WHEN n >= 2 AND labels > 1 THEN (same / n - rc / n / n) / (1 - rc / n / n) END, 6) AS kappa FROM t JOIN m USING (kind, a, b)""",
    "confusion": f"WITH {VD} SELECT kind, va, vb, count(*) AS n FROM pairs GROUP BY ALL",
    "verified_items": f"WITH {VD} SELECT kind, clip_id, count(*)::INT AS n_annotators, array_to_string(list_sort(list(DISTINCT verdict)), '|') AS verdicts, min((verdict = 'correct')::INT) AS verified FROM vd GROUP BY kind, clip_id",
    "corrected_truth": f"""WITH {W}, q AS (SELECT clip_id, printf('%.2f', word_start_sec) AS s, printf('%.2f', word_end_sec) AS e, surface FROM w),
        k AS (SELECT DISTINCT q.clip_id, s, e FROM q JOIN (SELECT DISTINCT clip_id FROM verified WHERE verified = 1) USING (clip_id)) SELECT surface, count(*) AS n FROM q JOIN k USING (clip_id, s, e) GROUP BY surface""",
    "release_words": f"""WITH {W}, {V}, v2 AS (SELECT clip_id, max(verified) AS verified, max(label_fix) AS label_fix FROM verified WHERE kind = 'word' GROUP BY 1),
        f AS (SELECT w.*, coalesce(w.surface IN (SELECT class FROM v WHERE labeling = 'surface'), false)::INT AS ins, coalesce(w.lemma_cls IN (SELECT class FROM v WHERE labeling = 'lemma'), false)::INT AS inl FROM w)
        SELECT f.clip_id, CASE WHEN ins = 1 THEN surface ELSE '' END AS label_surface, CASE WHEN inl = 1 THEN lemma_cls ELSE '' END AS label_lemma, ins AS in_vocab_surface, inl AS in_vocab_lemma, surface_form, lemma, word_start_sec, word_end_sec,
        speaker_id, channel, split, regexp_replace(replace(npz_path, chr(92), '/'), '^data/', '') AS npz_path, frame_start, frame_end, n_frames, fps, coalesce(verified::VARCHAR, '') AS verified, coalesce(label_fix, '') AS label_fix
        FROM f LEFT JOIN v2 ON f.clip_id = v2.clip_id""",
    "confidence_histogram": f"""WITH {W}, e AS (SELECT i, round((i * 0.05)::DOUBLE, 6) AS lo FROM range(0, 21) t(i)),
        b AS (SELECT split, least((SELECT count(*) FROM e WHERE lo <= least(greatest(confidence, 0.0), 1.0)), 20) AS bin FROM w WHERE confidence IS NOT NULL), k AS (SELECT split, bin, count(*) AS n FROM b GROUP BY ALL),
        g AS (SELECT s.split, i AS bin, lo0 AS lo FROM (SELECT DISTINCT split FROM w) s, (SELECT i + 1 AS i, lo AS lo0 FROM e WHERE i < 20)),
        x AS (SELECT g.split, g.lo, coalesce(k.n, 0) AS n FROM g LEFT JOIN k ON g.split IS NOT DISTINCT FROM k.split AND g.bin = k.bin)
        SELECT split AS "group", lo, n, round(CASE WHEN sum(n) OVER (PARTITION BY split) > 0 THEN n / sum(n) OVER (PARTITION BY split) END, 6) AS share FROM x""",
    "height_quantiles": f"WITH {W} SELECT split, count(face_height_px) AS n, round(quantile_cont(face_height_px::DOUBLE, 0.05), 6) AS p5, round(quantile_cont(face_height_px::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(face_height_px::DOUBLE, 0.95), 6) AS p95 FROM w GROUP BY split",
    "split_shares": f"WITH {W} SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM w), 6) AS share FROM w GROUP BY split",
    "rollup_total": "SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'TOTAL' ELSE l_returnflag END AS l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY ROLLUP (l_returnflag)",
    "distributions": f"""WITH {W}, x AS (SELECT 'letters' AS measure, length(surface)::INT AS value, surface FROM w WHERE surface <> '' UNION ALL SELECT 'syllables', {_syll("surface")}::INT, surface FROM w WHERE surface <> '')
        SELECT measure, value, count(*) AS clips, count(DISTINCT surface) AS classes FROM x GROUP BY ALL""",
    "pair_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL",
    "speaker_stats": f"""WITH {W}, {V} SELECT speaker_id, count(*) AS words, coalesce(array_to_string(list_sort(list(DISTINCT channel) FILTER (channel IS NOT NULL)), ' | '), '') AS channels, count(DISTINCT source_clip) AS source_clips,
        round(sum(n_frames / 25 / 3600), 6) AS hours, count(*) FILTER (track_ok = 1) AS words_kept, count(*) FILTER (track_ok = 1 AND lemma_cls IN (SELECT class FROM v)) AS words_in_vocab_lemma FROM w WHERE speaker_id IS NOT NULL GROUP BY 1""",
    "index_percentiles": """WITH x AS (SELECT list_sort(list(face_height_px)) AS xs FROM word_clips WHERE face_height_px IS NOT NULL)
        SELECT len(xs) AS n, xs[len(xs) // 10 + 1] AS p10, xs[len(xs) - len(xs) // 10] AS p90 FROM x""",
    "threshold_sweep": f"WITH t AS (SELECT word_sync_conf, coalesce(track_ok = 1, false) AS p FROM word_clips WHERE word_sync_conf IS NOT NULL) SELECT *, round(tpr - fpr, 6) AS youden FROM ({_SWEEP})",
    "shortest_per_reporter": f"WITH {R} SELECT reporter, clip_file, duration_sec FROM r WHERE duration_sec > 0 AND reporter IS NOT NULL QUALIFY row_number() OVER (PARTITION BY reporter ORDER BY duration_sec, clip_file) = 1",
    "progress_counts": f"WITH {R} SELECT reporter, count(*) AS n, count(*) FILTER (face_height_px >= 300) AS tall, round(sum(duration_sec) / 3600, 6) AS hours FROM r GROUP BY reporter",
    "components": "SELECT n_nationkey::VARCHAR AS nation, min(n_nationkey::VARCHAR) OVER (PARTITION BY n_regionkey) AS unit FROM nation",
    "split_search": """WITH u AS (SELECT c_mktsegment AS unit, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM customer GROUP BY 1),
        c AS (SELECT [unit] AS combo, share FROM u WHERE share BETWEEN 0.15 AND 0.45 UNION ALL SELECT [a.unit, b.unit], a.share + b.share FROM u a JOIN u b ON a.unit < b.unit WHERE a.share + b.share BETWEEN 0.15 AND 0.45),
        p AS (SELECT t.combo AS test, v.combo AS val, t.share AS ts, v.share AS vs FROM c t JOIN c v ON NOT list_has_any(t.combo, v.combo)),
        k AS (SELECT c_mktsegment AS unit, c_nationkey AS class, count(*) AS n FROM customer GROUP BY ALL), tot AS (SELECT class, sum(n) AS tot FROM k GROUP BY 1 HAVING sum(n) >= 1),
        h AS (SELECT p.*, tot.class, tot.tot - coalesce((SELECT sum(n) FROM k WHERE k.class = tot.class AND (list_contains(p.test, k.unit) OR list_contains(p.val, k.unit))), 0) AS left_n FROM p, tot)
        SELECT array_to_string(test, '|') AS test, array_to_string(val, '|') AS val, round(any_value(ts), 6) AS test_share, round(any_value(vs), 6) AS val_share, count(*) FILTER (left_n >= 1) AS classes FROM h GROUP BY test, val""",
    "offset_distances": """WITH v AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS x FROM embeddings), o AS (SELECT unnest(range(-3, 4)) AS "offset")
        SELECT v.label, v.i, o."offset"::INT AS "offset", round(list_distance(v.x, coalesce(a.x, list_transform(v.x, lambda y: 0.0::DOUBLE))), 4) AS dist FROM v CROSS JOIN o LEFT JOIN v a ON a.label = v.label AND a.i = v.i + o."offset" """,
    "best_offsets": """WITH v AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS x FROM embeddings), o AS (SELECT unnest(range(-3, 4)) AS f),
        d AS (SELECT v.label, f, list_distance(v.x, coalesce(a.x, list_transform(v.x, lambda y: 0.0::DOUBLE))) AS dist FROM v CROSS JOIN o LEFT JOIN v a ON a.label = v.label AND a.i = v.i + f),
        m AS (SELECT label, f, avg(dist) AS m, count(*) AS n FROM d GROUP BY ALL)
        SELECT label, CASE WHEN max(n) > 5 THEN -arg_min(f, m)::INT END AS "offset", round(min(m), 4) AS min_dist, round(quantile_cont(m, 0.5) - min(m), 4) AS confidence FROM m GROUP BY label""",
    "offset_distances_whole": """WITH v AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS x FROM embeddings), o AS (SELECT unnest(range(-15, 16)) AS "offset")
        SELECT v.label, v.i, o."offset"::INT AS "offset", round(list_distance(list_transform(v.x, lambda y: y + 1e-6), coalesce(a.x, list_transform(v.x, lambda y: 0.0::DOUBLE))), 4) AS dist FROM v CROSS JOIN o LEFT JOIN v a ON a.label = v.label AND a.i = v.i + o."offset" """,
    "best_offsets_whole": """WITH v AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS x FROM embeddings), o AS (SELECT unnest(range(-15, 16)) AS f),
        d AS (SELECT v.label, f, list_distance(list_transform(v.x, lambda y: y + 1e-6), coalesce(a.x, list_transform(v.x, lambda y: 0.0::DOUBLE))) AS dist FROM v CROSS JOIN o LEFT JOIN v a ON a.label = v.label AND a.i = v.i + f),
        m AS (SELECT label, f, avg(dist) AS m, count(*) AS n FROM d GROUP BY ALL)
        SELECT label, CASE WHEN max(n) > 30 THEN -arg_min(f, m)::INT END AS "offset", CASE WHEN max(n) > 30 THEN round(min(m), 4) END AS min_dist, CASE WHEN max(n) > 30 THEN round(quantile_cont(m, 0.5) - min(m), 4) END AS confidence FROM m GROUP BY label""",
    "video_ids": f"WITH {URL.replace('@SOURCE', 'reporter_clips')} SELECT {_ID.format('source_url')} AS video_id, url, count(*) AS n FROM urls GROUP BY 1, 2",
    "time_forms": f"""WITH {R} SELECT clip_file, printf('%02d:%02d:%02d', ceil(end_sec)::BIGINT // 3600, ceil(end_sec)::BIGINT % 3600 // 60, ceil(end_sec)::BIGINT % 60) AS hms,
        CASE WHEN start_sec = floor(start_sec) THEN printf('%d', start_sec::BIGINT) ELSE printf('%.2f', start_sec) END AS sec, ceil(end_sec) AS parsed, round_even(start_sec * 25, 0)::INT AS frame FROM r""",
    "span_frames": f"""WITH x AS (SELECT {_SPAN0.format('word_start_sec - clip_start_sec')} + coalesce(syncnet_offset, 0) AS f0, {_SPAN0.format('word_end_sec - clip_start_sec')} + coalesce(syncnet_offset, 0) AS f1, n_frames FROM word_clips),
        y AS (SELECT greatest(f0, 0) AS a, least(greatest(f1, f0 + 1), n_frames) AS b FROM x) SELECT CASE WHEN a < b THEN b - a END AS frames, count(*) AS n FROM y GROUP BY 1""",
    "item_names": r"""SELECT DISTINCT clip_id, speaker_id || printf('_w%04d', frame_start) AS word_id, speaker_id || printf('_s%03d', frame_start) || CASE WHEN frame_start > 100 THEN '_' || (frame_start % 3)::VARCHAR ELSE '' END AS sentence_id,
        coalesce(nullif(regexp_replace(regexp_replace(surface_form, '[^\p{L}\p{N}._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'unnamed') AS safe FROM word_clips""",
    "media_names": rf"""WITH {C} SELECT clip_id, substr(sha1(concat_ws('|', clip_id, split)), 1, 16) AS media, regexp_replace(regexp_replace(source_clip, '^.*/', ''), '\.[^.]*$', '') AS stem,
        regexp_replace(replace(source_clip, chr(92), '/'), '^data/', '') AS path FROM c""",
    "json_props": "SELECT event_type, sum((props->>'k')::INT)::BIGINT AS k, count(*) FILTER (props->>'k' IS NULL) AS unknown FROM events GROUP BY 1",
    "box_shifts": """WITH b AS (SELECT clip_id, max(source_clip) AS source_clip, max(mean_yaw) AS x, max(mean_pitch) AS y, max(mouth_width_px) AS w, max(face_height_px)::DOUBLE AS h FROM word_clips
            WHERE mouth_width_px IS NOT NULL AND face_height_px IS NOT NULL AND clip_id IS NOT NULL GROUP BY clip_id),
        n AS (SELECT *, lead(x) OVER o AS x2, lead(y) OVER o AS y2, lead(w) OVER o AS w2, lead(h) OVER o AS h2 FROM b WINDOW o AS (PARTITION BY source_clip ORDER BY clip_id))
        SELECT clip_id, round(sqrt(pow(2 * (x + w / 2 - x2 - w2 / 2), 2) + pow(3 * (y + h / 2 - y2 - h2 / 2), 2)) / greatest(1.0, 2 * least(w, w2)), 6) AS shift,
        round(CASE WHEN abs(x) + abs(w - x) = 0 THEN 1.0 ELSE abs(abs(w - x) - abs(x)) / (abs(w - x) + abs(x)) END, 6) AS yaw FROM n""",
    "suffix_join": f"""WITH {SPANS}, cf AS (SELECT *, CASE WHEN pos % 4 <> 3 THEN 0.6::DOUBLE + (pos % 5)::DOUBLE / 20 END AS conf FROM spans),
        m AS (SELECT *, sum((pos = 0 OR NOT coalesce({_SUFFIX}, false))::INT) OVER (PARTITION BY clip_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM cf),
        g AS (SELECT clip_id, min(pos) AS pos, string_agg(surface_form, '' ORDER BY pos) AS surface, count(*) AS n, arg_min(lemma, pos) AS lem, min(start_sec) AS start_sec, max(end_sec) AS end_sec, min(conf) AS conf,
            arg_min(coalesce((conf < 0.7)::INT, 0), pos) AS flag FROM m GROUP BY clip_id, run)
        SELECT clip_id, pos, surface AS surface_form, CASE WHEN n > 1 THEN {_FALL} ELSE lem END AS lemma, start_sec, end_sec, round(conf, 4) AS confidence, CASE WHEN n > 1 THEN (conf < 0.7)::INT ELSE flag END AS manual_review,
        row_number() OVER (PARTITION BY clip_id ORDER BY pos) - 1 AS word_index FROM g""",
    "word_gates": f"WITH {W} SELECT {_GATE} AS reason, count(*) AS n FROM w GROUP BY 1",
    "sentence_gates": """SELECT CASE WHEN NOT (sentence_end_sec - sentence_start_sec BETWEEN 1.0 AND 8.0) THEN 'duration' WHEN NOT n_frames > 0 THEN 'out_of_range' WHEN NOT coalesce(syncnet_score >= 2, true) THEN 'track_fail'
        WHEN n_words > 0 AND coalesce(sentence_sync_conf, 9) < 3 THEN 'offscreen_speech' END AS reason, count(*) AS n FROM sentence_clips GROUP BY 1""",
    "clip_gates": """SELECT CASE WHEN words = 0 THEN 'no_words' WHEN coalesce(frames, 0) <= 35 THEN 'too_short_for_sync' WHEN score < 3 THEN 'low_sync' ELSE 'ok' END AS status, count(*) AS n
        FROM (SELECT source_clip, count(surface_form) AS words, max(n_frames) AS frames, max(syncnet_score) AS score FROM word_clips GROUP BY 1) GROUP BY 1""",
    "transcript_slice": f"""WITH {SPANS} SELECT clip_id, round(min_by(round(start_sec - 1.0, 3), pos), 3) AS start_sec, round(max_by(round(end_sec - 1.0, 3), pos), 3) AS end_sec, string_agg(surface_form, ' ' ORDER BY pos) AS text, count(*)::INT AS n_words
        FROM spans WHERE start_sec >= 1.0 AND end_sec <= 3.0 GROUP BY clip_id""",
    "donor_clips": f"""WITH {R}, x AS (SELECT clip_file, reporter, duration_sec FROM r WHERE duration_sec IS NOT NULL AND reporter IS NOT NULL),
        pool AS (SELECT * FROM x ORDER BY md5('2026#' || clip_file), clip_file LIMIT 100),
        m AS (SELECT reporter AS o, duration_sec AS d, clip_file AS k FROM x QUALIFY row_number() OVER (PARTITION BY reporter ORDER BY duration_sec DESC, clip_file DESC) = 1), t AS (SELECT * FROM m ORDER BY d DESC, o LIMIT 2),
        c AS (SELECT x.clip_file, list(p.clip_file ORDER BY p.clip_file) AS ks FROM x JOIN pool p ON p.reporter <> x.reporter AND p.duration_sec >= x.duration_sec / 2 + 1 GROUP BY 1)
        SELECT x.*, CASE WHEN c.ks IS NOT NULL THEN c.ks[('0x' || substr(md5('2026#' || x.clip_file), 1, 8))::BIGINT % len(c.ks) + 1]
            ELSE (SELECT k FROM t WHERE t.o <> x.reporter AND t.d >= x.duration_sec / 2 + 1 ORDER BY d DESC, o LIMIT 1) END AS donor FROM x LEFT JOIN c USING (clip_file)""",
    "speaker_sets": f"""WITH a AS ({_SPK.format('word_clips')}), b AS ({_SPK.format('speaker_table')}) SELECT speaker_id, CASE WHEN a.speaker_id IS NOT NULL AND b.speaker_id IS NOT NULL THEN 'both' WHEN a.speaker_id IS NOT NULL THEN 'words' ELSE 'table' END AS side
        FROM a FULL JOIN b USING (speaker_id)""",
    "p7_speakers": f"""WITH w AS (SELECT {_key("speaker_id")} AS key, clip_id, appended_at, n_frames / fps / 3600 AS hours, confidence FROM word_clips),
        l AS (SELECT * FROM w WHERE clip_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key, clip_id ORDER BY appended_at DESC NULLS LAST, hours DESC NULLS LAST, confidence DESC NULLS LAST) = 1),
        r AS (SELECT key, count(*) AS rows FROM w GROUP BY key), s AS (SELECT key, count(*) AS clips, round(sum(hours), 6) AS hours, round(avg(confidence), 4) AS mean_confidence FROM l GROUP BY key)
        SELECT r.key, rows, coalesce(clips, 0) AS clips, coalesce(hours, 0) AS hours, mean_confidence FROM r LEFT JOIN s ON r.key IS NOT DISTINCT FROM s.key""",
    "p7_reporters": f"""WITH w AS (SELECT {_key("reporter")} AS key, clip_file AS clip_id, appended_at, duration_sec / 3600 AS hours FROM reporter_clips),
        l AS (SELECT * FROM w WHERE clip_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key, clip_id ORDER BY appended_at DESC NULLS LAST, hours DESC NULLS LAST) = 1),
        r AS (SELECT key, count(*) AS rows FROM w GROUP BY key), s AS (SELECT key, count(*) AS clips, round(sum(hours), 6) AS hours FROM l GROUP BY key)
        SELECT r.key, rows, coalesce(clips, 0) AS clips, coalesce(hours, 0) AS hours FROM r LEFT JOIN s ON r.key IS NOT DISTINCT FROM s.key""",
    "p7_found": f"""SELECT 'reporter_clips' AS table_name, {_key("reporter")} AS key_value FROM reporter_clips GROUP BY 2 HAVING key_value IS NOT NULL AND count(*) > (SELECT count(*) * 0.025 FROM reporter_clips)
        UNION ALL SELECT 'word_clips', {_key("speaker_id")} AS key_value FROM word_clips GROUP BY 2 HAVING key_value IS NOT NULL AND count(*) > (SELECT count(*) * 0.025 FROM word_clips)""",
}


def oracle_sql() -> dict[str, str]:
    return {**SQL, **extra.oracle_sql()}
