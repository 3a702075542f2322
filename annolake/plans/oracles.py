"""DuckDB SQL for every registered query (the correctness gate).

Each statement is self-contained: the corpus-shaped views over the driver
tables are inlined as CTEs. Written independently of the Spark plans (plain
window / join SQL, range joins, a recursive CTE for the greedy split), so a
match means two different formulations agree.
"""

from __future__ import annotations

from annolake.functions.columns import NULL_WORDS

# Fixed values shared with annolake/sources/tables.py
EV_ONSET = "((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000)"

VIEWS: dict[str, str] = {
    "ev_recordings": """
        SELECT user_id AS recording, CAST(2505600000 AS BIGINT) AS duration FROM events GROUP BY user_id""",
    "ev_segments": f"""
        SELECT user_id AS recording, event_id AS seg_id, event_type AS set_name,
               {EV_ONSET} AS onset,
               {EV_ONSET} + CAST(round(value * 60000) AS BIGINT) AS offset_ms
        FROM events""",
    "ev_files": f"""
        SELECT event_type AS "set", 'u' || user_id || '.wav' AS recording_filename,
               'u' || user_id || '.its' AS raw_filename, CAST(0 AS BIGINT) AS time_seek,
               {EV_ONSET} AS range_onset,
               {EV_ONSET} + CAST(round(value * 60000) AS BIGINT) AS range_offset,
               'u' || user_id || '_' || {EV_ONSET} || '_' || ({EV_ONSET} + CAST(round(value * 60000) AS BIGINT)) || '.csv'
                 AS annotation_filename,
               event_id AS seg_id
        FROM events""",
    "ev_file_recordings": """
        SELECT 'u' || user_id || '.wav' AS recording_filename, CAST(2505600000 AS BIGINT) AS duration,
               'u' || user_id AS child_id
        FROM events GROUP BY user_id""",
    "ev_labels": f"""
        SELECT s.*, l.label, l.value FROM (
          SELECT user_id AS recording, event_id AS seg_id, event_type AS set_name,
                 {EV_ONSET} AS onset, {EV_ONSET} + CAST(round(value * 60000) AS BIGINT) AS offset_ms
          FROM events) s
        JOIN (SELECT event_id, 'speaker_type' AS label, nullif(event_type, 'error') AS value FROM events
              UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events) l
          ON l.event_id = s.seg_id""",
    "docs_index": """
        SELECT doc_id AS key, lang AS dataset, source AS set_name, source || '/' || lang AS entity,
               n_chars AS weight
        FROM documents""",
    "doc_labels": """
        SELECT d.lang AS dataset, d.source AS set_name, d.doc_id AS file_key, CAST(0 AS BIGINT) AS onset,
               d.n_chars AS offset_ms, v.label, v.value
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
        CROSS JOIN LATERAL (VALUES ('quality', CAST(l.quality AS VARCHAR)), ('toxic', CAST(l.toxic AS VARCHAR))) v(label, value)""",
    "turns": """
        SELECT conv_id AS recording, turn, role AS set_name,
               CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS onset,
               CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT)
                 AS offset_ms,
               text
        FROM conversations""",
    "shop_children": """
        SELECT n_name AS dataset, c_custkey AS child_id, c_mktsegment AS child_sex,
               DATE '1990-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS child_dob
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "shop_recordings": """
        SELECT o_orderkey AS recording, o_custkey AS child_id, CAST(o_orderdate AS DATE) AS date_iso,
               CAST(round(o_totalprice * 100) AS BIGINT) AS duration,
               CASE WHEN o_orderstatus = 'P' THEN '1' END AS discard
        FROM orders""",
    "shop_annotations": """
        SELECT l_orderkey AS recording, l_returnflag AS set_name, l_linenumber AS line,
               CAST(0 AS BIGINT) AS range_onset, CAST(round(l_quantity * 1000) AS BIGINT) AS range_offset
        FROM lineitem""",
}


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    """Prefix ``body`` with the named views (and extra (name, sql) CTEs) as a WITH list."""
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({s})" for n, s in extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body


def support_sql(src: str, key: str, s: str, e: str, collar: int = 0) -> list[tuple[str, str]]:
    """Gaps-and-islands as plain window SQL: CTEs named _f, _g, islands."""
    return [
        ("_f", f"""SELECT {key} AS k, {s} AS s, {e} AS e,
                   max({e}) OVER (PARTITION BY {key} ORDER BY {s}, {e}
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
                   FROM {src} WHERE {s} < {e}"""),
        ("_g", f"""SELECT k, s, e, sum(CASE WHEN pm IS NULL OR (s - pm > 0 AND s - pm >= {collar}) THEN 1 ELSE 0 END)
                   OVER (PARTITION BY k ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM _f"""),
        ("islands", "SELECT k, min(s) AS cs, max(e) AS ce FROM _g GROUP BY k, isl"),
    ]


def clipped_sql(seg: str, rec: str, key: str, on: str, off: str, pad: int) -> str:
    return f"""SELECT a.{key} AS {key}, greatest(a.{on} - {pad}, 0) AS s, least(a.{off} + {pad}, r.duration) AS e
               FROM {seg} a JOIN {rec} r ON r.{key} = a.{key}"""


PAD = 1_800_000      # 30 minutes
COLLAR = 600_000     # 10 minutes

ORACLES: dict[str, str] = {}

# --- intervals ---------------------------------------------------------------------

ORACLES["interval_support"] = with_views(
    ["ev_segments", "ev_recordings"],
    "SELECT k AS recording, cs AS clip_start, ce AS clip_end FROM islands",
    [("c", clipped_sql("ev_segments", "ev_recordings", "recording", "onset", "offset_ms", 0))]
    + support_sql("c", "recording", "s", "e"))

ORACLES["interval_support_collar"] = with_views(
    ["ev_segments", "ev_recordings"],
    "SELECT k AS recording, cs AS clip_start, ce AS clip_end FROM islands",
    [("c", clipped_sql("ev_segments", "ev_recordings", "recording", "onset", "offset_ms", 0))]
    + support_sql("c", "recording", "s", "e", COLLAR))

ORACLES["interval_covered"] = with_views(
    ["ev_segments", "ev_recordings"],
    """SELECT k AS recording, CAST(sum(ce - cs) AS BIGINT) AS covered_ms, count(*) AS n_clips
       FROM islands GROUP BY k""",
    [("c", clipped_sql("ev_segments", "ev_recordings", "recording", "onset", "offset_ms", PAD))]
    + support_sql("c", "recording", "s", "e"))

_CLIPS_EV = ([("c", clipped_sql("ev_files", "ev_file_recordings", "recording_filename",
                                "range_onset", "range_offset", PAD))]
             + support_sql("c", "recording_filename", "s", "e")
             + [("clips", """SELECT k AS recording_filename, cs, ce,
                             regexp_replace(k, '\\.wav$', '') || '-' || cs || 'to' || ce || '.wav' AS clip_filename
                             FROM islands""")])

ORACLES["clip_list"] = with_views(
    ["ev_files", "ev_file_recordings"],
    "SELECT recording_filename, cs AS clip_start, ce AS clip_end, clip_filename FROM clips", _CLIPS_EV)

ORACLES["clip_list_seek"] = with_views(
    ["ev_files", "ev_file_recordings"],
    """SELECT k AS recording_filename, cs AS clip_start, ce AS clip_end,
              regexp_replace(k, '\\.wav$', '') || '-' || cs || 'to' || ce || '.wav' AS clip_filename FROM islands""",
    [("f", """SELECT recording_filename, range_onset + seg_id % 5 * 600000 AS a, range_offset + seg_id % 5 * 600000 AS b
              FROM ev_files"""),
     ("c", clipped_sql("f", "ev_file_recordings", "recording_filename", "a", "b", 0))]
    + support_sql("c", "recording_filename", "s", "e"))

ORACLES["cut_manifest"] = with_views(
    ["ev_files", "ev_file_recordings"],
    """SELECT DISTINCT version, source, cs AS "start", ce AS "end",
              regexp_replace(source, '\\.[^./]*$', '') || '-' || cs || 'to' || ce ||
              regexp_extract(source, '(\\.[^./]*)$', 1) AS output
       FROM (SELECT 'raw' AS version, 'recordings/raw/' || regexp_replace(recording_filename, '\\.wav$', '.mp3') AS source, cs, ce FROM clips
             UNION ALL
             SELECT 'standard', 'recordings/converted/standard/' || recording_filename, cs, ce FROM clips) j""",
    _CLIPS_EV)

_ASSIGN_EV = _CLIPS_EV + [("asg", """
    SELECT a.*, c.cs, c.ce, c.clip_filename
    FROM ev_files a LEFT JOIN clips c
      ON c.recording_filename = a.recording_filename AND c.cs <= a.range_onset AND a.range_offset <= c.ce""")]

ORACLES["clip_assign_rebase"] = with_views(
    ["ev_files", "ev_file_recordings"],
    """SELECT seg_id, "set", clip_filename AS recording_filename, recording_filename AS original_recording_filename,
              range_onset - cs AS range_onset, range_offset - cs AS range_offset, CAST(0 AS BIGINT) AS time_seek,
              regexp_replace(clip_filename, '\\.wav$', '') || '_' || (range_onset - cs) || '_' || (range_offset - cs) || '.csv'
                AS annotation_filename,
              annotation_filename AS original_annotation_filename,
              regexp_replace(clip_filename, '\\.wav$', '') || '.its' AS raw_filename
       FROM asg WHERE cs IS NOT NULL""",
    _ASSIGN_EV)

ORACLES["clip_discarded"] = with_views(
    ["ev_files", "ev_file_recordings"],
    "SELECT seg_id, recording_filename, range_onset, range_offset FROM asg WHERE cs IS NULL",
    _ASSIGN_EV)

ORACLES["clip_superseded"] = with_views(
    ["ev_files", "ev_file_recordings"],
    "SELECT DISTINCT recording_filename FROM asg WHERE cs IS NOT NULL",
    _ASSIGN_EV)

ORACLES["clip_renames"] = with_views(
    ["ev_files", "ev_file_recordings"],
    """SELECT DISTINCT "set", annotation_filename AS old_name,
              regexp_replace(clip_filename, '\\.wav$', '') || '_' || (range_onset - cs) || '_' || (range_offset - cs) || '.csv'
                AS new_name
       FROM asg WHERE cs IS NOT NULL""",
    _ASSIGN_EV)

ORACLES["recordings_on_clips"] = with_views(
    ["ev_files", "ev_file_recordings"],
    """SELECT DISTINCT c.clip_filename AS recording_filename, r.child_id, CAST(c.ce - c.cs AS BIGINT) AS duration,
              'benchmarking' AS experiment
       FROM ev_file_recordings r JOIN clips c ON c.recording_filename = r.recording_filename""",
    _CLIPS_EV)

ORACLES["slice_payload"] = with_views(
    ["turns"],
    """SELECT t.recording, t.turn, i.cs AS clip_start, i.ce AS clip_end,
              greatest(t.onset, i.cs) - i.cs AS piece_start, least(t.offset_ms, i.ce) - i.cs AS piece_end,
              substring(t.text, greatest(t.onset, i.cs) - t.onset + 1,
                        least(t.offset_ms, i.ce) - greatest(t.onset, i.cs)) AS text
       FROM turns t JOIN islands i ON i.k = t.recording AND greatest(t.onset, i.cs) < least(t.offset_ms, i.ce)""",
    [("ev", "SELECT recording, onset + 10 AS s, offset_ms + 15 AS e FROM turns WHERE turn % 2 = 0")]
    + support_sql("ev", "recording", "s", "e"))

# --- splitting ---------------------------------------------------------------------


def _wsplit(by: str, seed: int, pm: tuple[int, int, int], key: str = "key", weight: str = "weight",
            src: str = "docs_index") -> str:
    a, b = pm[0], pm[0] + pm[1]
    return f"""SELECT *, CASE WHEN cum * 1000 <= tot * {a} THEN 'train'
                              WHEN cum * 1000 <= tot * {b} THEN 'test' ELSE 'validate' END AS split
               FROM (SELECT *, sum({weight}) OVER (PARTITION BY {by} ORDER BY md5('{seed}:' || {key}), {key}
                                                  ROWS UNBOUNDED PRECEDING) AS cum,
                              sum({weight}) OVER (PARTITION BY {by}) AS tot
                     FROM {src}) x"""


_DOC_COLS = "key, dataset, set_name, entity, weight, split"

ORACLES["weighted_split"] = with_views(
    ["docs_index"], f"SELECT {_DOC_COLS} FROM ws", [("ws", _wsplit("dataset", 0, (800, 100, 100)))])
ORACLES["weighted_split_stratified"] = with_views(
    ["docs_index"], f"SELECT {_DOC_COLS} FROM ws", [("ws", _wsplit("dataset, set_name", 1, (700, 200, 100)))])
ORACLES["weighted_split_two_level"] = with_views(
    ["docs_index"], f"SELECT {_DOC_COLS} FROM ws", [("ws", _wsplit("dataset", 7, (600, 300, 100)))])


def _entity_ctes(ent: str, entity: str, shuffled: str, pm=(800, 100, 100), shards: int = 1, heads: int = 1000) -> list[tuple[str, str]]:
    """T4 in SQL: the heavy entities one after the other (recursive), then the others cut at the levelled gaps.
    ``ent``: one row (its columns, w) for each entity; ``entity``: its text; ``shuffled``: its place in the shuffle."""
    shard = f"('0x' || substr(md5({entity}), 1, 8))::BIGINT % {shards}" if shards > 1 else "0"
    gap = [f"(t.tot * {p} - 1000 * h.c{k})" for k, p in enumerate(pm)]
    pick = f"CASE WHEN {gap[0]} >= {gap[1]} AND {gap[0]} >= {gap[2]} THEN 'train' WHEN {gap[1]} >= {gap[2]} THEN 'test' ELSE 'validate' END"
    more = ", ".join(f"h.c{k} + CASE WHEN {pick} = '{n}' THEN o.w ELSE 0 END" for k, n in enumerate(("train", "test", "validate")))
    return [
        ("ent0", ent),
        ("ent", f"SELECT *, {entity} AS e, {shuffled} AS sk, {shard} AS shard FROM ent0"),
        ("t", "SELECT shard, CAST(sum(w) AS HUGEINT) AS tot, CAST(sum(abs(w)) AS HUGEINT) AS size FROM ent GROUP BY shard"),
        ("sized", f"SELECT ent.*, CAST(abs(w) AS HUGEINT) * {heads} > t.size AS heavy FROM ent JOIN t USING (shard)"),
        ("ord", "SELECT *, row_number() OVER (PARTITION BY shard ORDER BY sk, e) AS rn FROM sized WHERE heavy"),
        ("h", f"""SELECT shard, 0 AS rn, CAST(NULL AS VARCHAR) AS e, CAST(NULL AS VARCHAR) AS split,
                         CAST(0 AS HUGEINT) AS c0, CAST(0 AS HUGEINT) AS c1, CAST(0 AS HUGEINT) AS c2 FROM t
                  UNION ALL
                  SELECT o.shard, o.rn, o.e, {pick}, {more}
                  FROM h JOIN ord o ON o.shard = h.shard AND o.rn = h.rn + 1 JOIN t ON t.shard = h.shard"""),
        ("gaps", "SELECT shard, tot, " + ", ".join(f"tot * {p} - 1000 * c{k} AS g{k}" for k, p in enumerate(pm))
                 + ", 1000 * (tot - c0 - c1 - c2) AS rest FROM h JOIN t USING (shard) QUALIFY rn = max(rn) OVER (PARTITION BY shard)"),
        ("down", "SELECT *, list_reverse_sort([g0, g1, g2]) AS d FROM gaps"),
        ("levels", """SELECT *, CASE WHEN 6 * (d[1] - rest) >= 6 * d[2] THEN 6 * (d[1] - rest)
                                     WHEN 3 * (d[1] + d[2] - rest) >= 6 * d[3] THEN 3 * (d[1] + d[2] - rest)
                                     ELSE 2 * (d[1] + d[2] + d[3] - rest) END AS l FROM down"""),
        ("bounds", "SELECT shard, greatest(6 * g0 - l, 0) AS b1, greatest(6 * g0 - l, 0) + greatest(6 * g1 - l, 0) AS b2 FROM levels"),
        ("run", "SELECT e, shard, sum(w) OVER (PARTITION BY shard ORDER BY sk, e ROWS UNBOUNDED PRECEDING) AS cum FROM sized WHERE NOT heavy"),
        ("es", """SELECT e, split FROM h WHERE e IS NOT NULL
                  UNION ALL
                  SELECT e, CASE WHEN cum * 6000 <= b1 THEN 'train' WHEN cum * 6000 <= b2 THEN 'test' ELSE 'validate' END
                  FROM run JOIN bounds USING (shard)""")]


_DOC_ENTITY = ("SELECT entity, CAST(sum(weight) AS BIGINT) AS w FROM docs_index GROUP BY entity",
               "coalesce(CAST(entity AS VARCHAR), chr(0))", "md5(concat_ws(':', '0', entity))")
_ENTITIES = _entity_ctes(*_DOC_ENTITY)


def _with_recursive(names, body, extra):
    sql = with_views(names, body, extra)
    return "WITH RECURSIVE" + sql[len("WITH"):]


for _name, _ctes in (("entity_split", _ENTITIES), ("entity_split_sharded", _entity_ctes(*_DOC_ENTITY, shards=4))):
    ORACLES[_name] = _with_recursive(
        ["docs_index"], "SELECT d.key, d.entity, d.weight, es.split FROM docs_index d JOIN es ON es.e = coalesce(d.entity, chr(0))", _ctes)

ORACLES["split_exclusive_check"] = with_views(
    ["docs_index"],
    "SELECT entity, count(DISTINCT split) AS n_splits FROM ws GROUP BY entity HAVING count(DISTINCT split) > 1",
    [("ws", _wsplit("dataset", 0, (800, 100, 100)))])

ORACLES["split_report"] = _with_recursive(
    ["docs_index"],
    """SELECT s.split, CAST((SELECT sum(weight) FROM docs_index) AS DOUBLE) * s.pm / 1000.0 AS desired_weight,
              CAST(coalesce(r.reached, 0) AS BIGINT) AS reached_weight
       FROM (VALUES ('train', 800), ('test', 100), ('validate', 100)) s(split, pm)
       LEFT JOIN (SELECT es.split, sum(d.weight) AS reached FROM docs_index d JOIN es ON es.e = coalesce(d.entity, chr(0))
                  GROUP BY es.split) r ON r.split = s.split""", _ENTITIES)

_SPLIT_INPUT = """
    SELECT a.recording, a.set_name, a.line, r.child_id, c.dataset,
           round(datediff('day', c.child_dob, r.date_iso) / 30.4375, 2) AS age_months,
           a.range_onset, a.range_offset, a.range_offset - a.range_onset AS duration_ms,
           'datasets/' || c.dataset || '/annotations/' || a.set_name || '/converted/' || a.recording || '_'
             || a.range_onset || '_' || a.range_offset || '.csv' AS annotation_path,
           'datasets/' || c.dataset || '/recordings/converted/standard/' || a.recording || '.mp3' AS recording_path
    FROM shop_annotations a
    LEFT JOIN (SELECT * FROM shop_recordings WHERE discard IS NULL OR lower(trim(discard)) NOT IN ('1', '1.0', 'true')) r
      ON r.recording = a.recording
    LEFT JOIN shop_children c ON c.child_id = r.child_id"""

ORACLES["split_input"] = with_views(
    ["shop_annotations", "shop_recordings", "shop_children"], "SELECT * FROM si", [("si", _SPLIT_INPUT)])

ORACLES["split_finalize"] = with_views(
    ["shop_annotations", "shop_recordings", "shop_children"],
    """SELECT DISTINCT recording, set_name, line, child_id, dataset, range_onset, range_offset, duration_ms,
              annotation_path, regexp_replace(recording_path, '\\.[^./]*$', '') || '.wav' AS recording_path, split
       FROM ws""",
    [("si", _SPLIT_INPUT),
     ("si2", "SELECT *, concat_ws(':', recording, line, set_name, range_offset) AS _key FROM si"),
     ("ws", _wsplit("dataset", 0, (800, 100, 100), key="_key", weight="duration_ms", src="si2"))])

# --- profiling ----------------------------------------------------------------------

VIEWS["doc_sidecars"] = """
    SELECT lang AS dataset, source AS set_name,
           CASE WHEN lang = 'en' THEN count(*) WHEN lang = 'es' THEN 0 END AS sampling_count,
           CASE WHEN lang <> 'fr' THEN 60000 END AS sampling_unit_duration,
           CASE WHEN lang = 'de' THEN 'N' ELSE 'Y' END AS has_speaker_type,
           CASE WHEN lang = 'fr' THEN 'y' WHEN lang = 'es' THEN 'Y' END AS has_addressee,
           source AS segmentation,
           CASE WHEN source = 'src19' THEN 'automated' ELSE 'manual' END AS method,
           'random' AS sampling_method,
           CASE WHEN lang = 'fr' THEN 'xyz' ELSE 'chi' END AS sampling_target,
           CASE WHEN lang = 'de' THEN '2024-13-01' ELSE '2024-02-01' END AS date_annotation
    FROM documents WHERE source <> 'src18' GROUP BY lang, source"""
VIEWS["doc_files"] = """
    SELECT lang AS dataset, source AS set_name, doc_id AS file_key,
           doc_id || '_0_' || n_chars || '.csv' AS annotation_filename
    FROM documents"""
VIEWS["doc_index"] = """
    SELECT DISTINCT lang AS dataset, source AS set_name, 'vtc_cols' AS category, 'quality' AS "column" FROM documents
    UNION ALL
    SELECT DISTINCT lang, source, CASE WHEN lang IN ('en', 'fr') THEN 'addressee_cols' ELSE 'other' END, 'toxic'
    FROM documents"""


def _label_profile(src: str, by: str) -> list[tuple[str, str]]:
    return [
        ("l1", f"""SELECT {by}, label, value, sum(offset_ms - onset) AS ms, count(*) AS n
                   FROM {src} GROUP BY {by}, label, value"""),
        ("lp", f"""SELECT {by}, label AS "column",
                          CAST(coalesce(sum(ms) FILTER (WHERE value IS NOT NULL), 0) AS BIGINT) AS annotated_ms,
                          CAST(coalesce(sum(n) FILTER (WHERE value IS NOT NULL), 0) AS BIGINT) AS num_non_empty,
                          count(*) AS n_values, count(*) <= 20 AS categorical,
                          CASE WHEN count(*) <= 20 THEN
                            coalesce(list_sort(list(value) FILTER (WHERE value IS NOT NULL)), CAST([] AS VARCHAR[]))
                          END AS "values"
                   FROM l1 GROUP BY {by}, label"""),
    ]


_SPAN_RE = r"_(-?\d+)_(-?\d+)(\.[^_/]*)?$"
_SAMPLED = ("sd", f"""
    SELECT s.dataset, s.set_name,
           CAST(CASE WHEN coalesce(s.sampling_count, 0) <> 0 AND coalesce(s.sampling_unit_duration, 0) <> 0
                     THEN s.sampling_count * s.sampling_unit_duration ELSE coalesce(f.span_ms, 0) END AS BIGINT)
             AS duration_from_samples_ms,
           CAST(coalesce(s.sampling_count, f.n_files, 0) AS BIGINT) AS number_of_samples
    FROM doc_sidecars s LEFT JOIN (
      SELECT dataset, set_name, count(*) AS n_files,
             sum(CAST(regexp_extract(annotation_filename, '{_SPAN_RE}', 2) AS BIGINT)
                 - CAST(regexp_extract(annotation_filename, '{_SPAN_RE}', 1) AS BIGINT)) AS span_ms
      FROM doc_files GROUP BY dataset, set_name) f
    ON f.dataset = s.dataset AND f.set_name = s.set_name""")
_SAMPLED_GOLD = ("sd", _SAMPLED[1] + " WHERE s.method = 'manual'")
_PROFILE = _label_profile("doc_labels", "dataset, set_name") + [_SAMPLED_GOLD, ("prof", """
    SELECT lp.dataset, lp.set_name, lp."column", lp.categorical, lp.annotated_ms AS annotated_duration_ms,
           sd.duration_from_samples_ms, sd.number_of_samples, lp.num_non_empty AS num_of_non_empty_segments
    FROM lp JOIN sd ON sd.dataset = lp.dataset AND sd.set_name = lp.set_name""")]
_DOC_META = ["doc_labels", "doc_sidecars", "doc_files", "doc_index"]

ORACLES["label_profile"] = with_views(["doc_labels"], "SELECT * FROM lp", _label_profile("doc_labels", "dataset, set_name"))
ORACLES["label_categorical"] = with_views(["ev_labels"], "SELECT * FROM lp", _label_profile("ev_labels", "set_name"))
ORACLES["sampled_duration"] = with_views(["doc_sidecars", "doc_files"], "SELECT * FROM sd", [_SAMPLED])
ORACLES["generated_profile"] = with_views(_DOC_META, "SELECT * FROM prof", _PROFILE)
ORACLES["category_summary"] = with_views(_DOC_META, """
    SELECT dataset, set_name, ((sum(annotated_duration_ms) * 1000 + 30000) // 60000) / 1000.0 AS annotated_total_duration_min,
           ((max(duration_from_samples_ms) * 1000 + 30000) // 60000) / 1000.0 AS sampled_total_duration_min,
           CAST(sum(num_of_non_empty_segments) AS BIGINT) AS num_of_segments_non_empty,
           CAST(max(number_of_samples) AS BIGINT) AS num_of_samples
    FROM prof p
    WHERE EXISTS (SELECT 1 FROM doc_index i WHERE i.dataset = p.dataset AND i.set_name = p.set_name
                  AND i."column" = p."column" AND i.category IN ('vtc', 'vtc_cols'))
    GROUP BY dataset, set_name HAVING sum(annotated_duration_ms) <> 0""", _PROFILE)
ORACLES["corpora_info"] = with_views(_DOC_META, """
    SELECT s.dataset, s.set_name, ((s.smp * 100 + 30000) // 60000) / 100.0 AS sampled_duration_minutes,
           ((coalesce(a.ann, 0) * 100 + 30000) // 60000) / 100.0 AS duration_annotated_minutes
    FROM (SELECT dataset, set_name, max(duration_from_samples_ms) AS smp FROM prof GROUP BY ALL) s
    LEFT JOIN (SELECT p.dataset, p.set_name, sum(p.annotated_duration_ms) AS ann FROM prof p
               JOIN doc_index i ON i.dataset = p.dataset AND i.set_name = p.set_name AND i."column" = p."column"
                 AND i.category IN ('addressee', 'addressee_cols')
               GROUP BY ALL) a ON a.dataset = s.dataset AND a.set_name = s.set_name
    WHERE EXISTS (SELECT 1 FROM doc_sidecars c WHERE c.dataset = s.dataset AND c.set_name = s.set_name
                  AND upper(c.has_addressee) = 'Y')""", _PROFILE)

# --- validation ---------------------------------------------------------------------

_V1_FIELDS = [("method", "enum", ("automated", "manual", "mixed", "derivation", "citizen-scientists")),
              ("sampling_method", "enum", ("none", "manual", "periodic", "random", "high-volubility", "high-energy")),
              ("sampling_target", "enum", ("chi", "fem", "mal", "och")),
              ("sampling_count", "int", ()), ("sampling_unit_duration", "int", ()),
              ("date_annotation", "date", ()),
              ("has_speaker_type", "enum", ("Y", "N")), ("has_addressee", "enum", ("Y", "N"))]


def _v1_sql() -> str:
    parts = []
    for f, kind, allowed in _V1_FIELDS:
        v = f"CAST({f} AS VARCHAR)"
        if kind == "int":
            cond = f"TRY_CAST({v} AS BIGINT) IS NULL"
        elif kind == "date":
            cond = f"TRY_CAST({v} AS DATE) IS NULL"
        else:
            cond = f"{v} NOT IN ({', '.join(repr(a) for a in allowed)})"
        parts.append(f"SELECT dataset, set_name, '{f}=' || {v} AS detail FROM doc_sidecars "
                     f"WHERE {f} IS NOT NULL AND {cond}")
    return " UNION ALL ".join(parts)


ORACLES["check_sidecar_values"] = with_views(
    ["doc_sidecars"], "SELECT dataset, set_name, 'sidecar_value' AS \"check\", detail FROM v1", [("v1", _v1_sql())])

ORACLES["check_index_columns"] = with_views(_DOC_META, """
    SELECT coalesce(i.dataset, p.dataset) AS dataset, coalesce(i.set_name, p.set_name) AS set_name,
           'index_columns' AS "check",
           CASE WHEN i."column" IS NULL THEN 'not in index: ' || p."column"
                ELSE 'not in profile: ' || i."column" END AS detail
    FROM (SELECT DISTINCT dataset, set_name, "column" FROM doc_index) i
    FULL OUTER JOIN (SELECT DISTINCT dataset, set_name, "column" FROM prof) p
      ON i.dataset = p.dataset AND i.set_name = p.set_name AND i."column" = p."column"
    WHERE (i."column" IS NULL OR p."column" IS NULL)
      AND (coalesce(i.dataset, p.dataset), coalesce(i.set_name, p.set_name)) IN
          (SELECT dataset, set_name FROM doc_index)""", _PROFILE)

ORACLES["check_index_sets"] = with_views(_DOC_META, """
    SELECT coalesce(i.dataset, p.dataset) AS dataset, coalesce(i.set_name, p.set_name) AS set_name,
           'index_sets' AS "check",
           CASE WHEN i.set_name IS NULL THEN 'set not in index' ELSE 'set not in profile' END AS detail
    FROM (SELECT DISTINCT dataset, set_name FROM doc_index) i
    FULL OUTER JOIN (SELECT DISTINCT dataset, set_name FROM prof) p
      ON i.dataset = p.dataset AND i.set_name = p.set_name
    WHERE (i.set_name IS NULL OR p.set_name IS NULL)
      AND coalesce(i.dataset, p.dataset) IN (SELECT dataset FROM doc_index)
      AND coalesce(i.dataset, p.dataset) IN (SELECT dataset FROM prof)
    UNION ALL
    SELECT DISTINCT dataset, CAST(NULL AS VARCHAR), 'unknown_corpus', 'corpus not in profile' FROM doc_index
    WHERE dataset NOT IN (SELECT dataset FROM prof)""", _PROFILE)

_FLAG_GRID = _PROFILE + [("fg", """
    SELECT g.dataset, g.set_name, g.category, g.flag, CAST(coalesce(a.ann, 0) AS BIGINT) AS annotated_ms,
           coalesce(CASE g.flag WHEN 'has_addressee' THEN sc.has_addressee
                                WHEN 'has_speaker_type' THEN sc.has_speaker_type END, 'N') AS flag_value
    FROM (SELECT s.dataset, s.set_name, c.category, c.list, c.flag
          FROM (SELECT DISTINCT dataset, set_name FROM doc_index) s
          CROSS JOIN (VALUES ('addressee', 'addressee_cols', 'has_addressee'), ('vcm', 'vcm_cols', 'has_vcm_type'),
                             ('vtc', 'vtc_cols', 'has_speaker_type'),
                             ('transcription', 'transcription_cols', 'has_transcription')) c(category, list, flag)) g
    LEFT JOIN (SELECT i.dataset, i.set_name, i.category AS list, sum(p.annotated_duration_ms) AS ann
               FROM doc_index i JOIN prof p ON p.dataset = i.dataset AND p.set_name = i.set_name
                 AND p."column" = i."column" GROUP BY ALL) a
      ON a.dataset = g.dataset AND a.set_name = g.set_name AND a.list = g.list
    JOIN doc_sidecars sc ON sc.dataset = g.dataset AND sc.set_name = g.set_name""")]

ORACLES["check_missing_flag"] = with_views(_DOC_META, """
    SELECT dataset, set_name, 'missing_flag' AS "check", flag || ' missing (' || annotated_ms || ' ms)' AS detail
    FROM fg WHERE annotated_ms > 0 AND upper(flag_value) <> 'Y'""", _FLAG_GRID)

ORACLES["check_false_flag"] = with_views(_DOC_META, """
    SELECT dataset, set_name, 'false_flag' AS "check", flag || ' set but 0 ms' AS detail
    FROM fg WHERE annotated_ms = 0 AND upper(flag_value) = 'Y'""", _FLAG_GRID)

ORACLES["check_sidecar_missing"] = with_views(["doc_index", "doc_sidecars"], """
    SELECT DISTINCT i.dataset, i.set_name, 'sidecar_missing' AS "check", 'no sidecar' AS detail
    FROM doc_index i WHERE NOT EXISTS (SELECT 1 FROM doc_sidecars s
                                       WHERE s.dataset = i.dataset AND s.set_name = i.set_name)""")

ORACLES["check_index_fields"] = with_views(["doc_index"], """
    SELECT dataset, set_name, 'index_field' AS "check", 'missing ' || l AS detail
    FROM (SELECT DISTINCT dataset, set_name FROM doc_index) s
    CROSS JOIN (VALUES ('addressee_cols'), ('vcm_cols'), ('vtc_cols'), ('transcription_cols'), ('other')) v(l)
    WHERE NOT EXISTS (SELECT 1 FROM doc_index i WHERE i.dataset = s.dataset AND i.set_name = s.set_name
                      AND i.category = v.l)""")

# --- statistics ---------------------------------------------------------------------

VIEWS["shop_sidecars"] = """
    SELECT DISTINCT l_returnflag AS set_name,
           CASE WHEN l_returnflag = 'R' THEN 'automated' ELSE 'manual' END AS method
    FROM lineitem WHERE l_returnflag <> 'N'"""

_KEPT_REC = ("rk", """SELECT * FROM shop_recordings
                     WHERE discard IS NULL OR lower(trim(discard)) NOT IN ('1', '1.0', 'true')""")
_SEGS = [_KEPT_REC, ("segs", """
    SELECT c.dataset, coalesce(CAST(c.child_sex AS VARCHAR), 'N/A') AS child_sex,
           a.range_offset - a.range_onset AS d
    FROM shop_children c JOIN rk r ON r.child_id = c.child_id JOIN shop_annotations a ON a.recording = r.recording
    WHERE a.set_name IN (SELECT set_name FROM shop_sidecars WHERE method = 'manual')""")]
_SHOP = ["shop_children", "shop_recordings", "shop_annotations", "shop_sidecars"]

ORACLES["distribution_mean"] = with_views(_SHOP, """
    SELECT dataset, child_sex, avg(d) AS duration_mean, count(d) AS "count" FROM segs GROUP BY ALL""", _SEGS)
ORACLES["distribution_std"] = with_views(_SHOP, """
    SELECT dataset, child_sex, round(stddev_samp(d), 6) AS duration_std, count(d) AS "count" FROM segs GROUP BY ALL""",
    _SEGS)
ORACLES["distribution_total"] = with_views(_SHOP, """
    SELECT dataset, child_sex, CAST(sum(d) AS DOUBLE) / 3600000.0 AS duration_total, count(d) AS "count"
    FROM segs GROUP BY ALL""", _SEGS)
ORACLES["distribution_count"] = with_views(_SHOP, """
    SELECT dataset, child_sex, count(d) AS "count" FROM segs GROUP BY ALL""", _SEGS)
ORACLES["pooled_mean"] = with_views(_SHOP, """
    SELECT child_sex, round(sum(m * n) / sum(n), 6) AS duration_mean
    FROM (SELECT dataset, child_sex, avg(d) AS m, count(d) AS n FROM segs GROUP BY ALL) x
    GROUP BY child_sex""", _SEGS)
ORACLES["pooled_std"] = with_views(_SHOP, """
    SELECT child_sex, round(sqrt(sum(s * s * n) / sum(n)), 6) AS duration_std
    FROM (SELECT dataset, child_sex, round(stddev_samp(d), 6) AS s, count(d) AS n FROM segs GROUP BY ALL) x
    GROUP BY child_sex""", _SEGS)

VIEWS["shop_subjects"] = """
    SELECT c.dataset, c.child_id, c.child_dob,
           CASE WHEN c.child_id % 7 = 0 THEN NULL WHEN c.child_id % 3 = 0 THEN 'F' WHEN c.child_id % 3 = 1 THEN 'm' ELSE 'Male' END AS child_sex,
           CASE c.child_sex WHEN 'BUILDING' THEN 'en; fr' WHEN 'MACHINERY' THEN NULL ELSE lower(c.child_sex[1:2]) END AS languages,
           CASE WHEN c.child_id % 5 = 0 THEN 'N' WHEN c.child_id % 5 < 4 THEN 'Y' END AS normative,
           CASE WHEN c.child_id % 5 = 0 THEN lower(c.child_sex) END AS normative_criterion,
           'extrapolated' AS dob_criterion, CASE WHEN c.child_id % 2 = 0 THEN 'day' ELSE 'month' END AS dob_accuracy,
           c.child_id % 11 = 0 AS gone
    FROM shop_children c"""
VIEWS["shop_segments"] = """
    SELECT l_orderkey AS recording, l_returnflag AS set_name, CAST(round(l_quantity * 1000) AS BIGINT) AS d,
           CASE WHEN l_linenumber > 1 THEN l_linestatus END AS speaker_type, CAST(l_suppkey % 20 AS VARCHAR) AS speaker_id
    FROM lineitem"""

_AGES = [_KEPT_REC, ("ra", """
    SELECT r.*, c.dataset, datediff('day', c.child_dob, r.date_iso) / 30.4375 AS age_raw,
           round(datediff('day', c.child_dob, r.date_iso) / 30.4375, 2) AS age
    FROM rk r JOIN shop_children c ON c.child_id = r.child_id""")]

ORACLES["subject_age_bins"] = with_views(_SHOP, """
    SELECT dataset, age_bin, round(min(mn + (age_bin - 1) * w), 6) AS age_bin_lo,
           round(max(mn + age_bin * w), 6) AS age_bin_hi, count(*) AS "count",
           CAST(sum(duration) AS DOUBLE) / 3600000.0 AS duration_total
    FROM (SELECT ra.*, mm.mn, (mm.mx - mm.mn) / 10 AS w,
                 CAST(CASE WHEN (mm.mx - mm.mn) / 10 > 0
                           THEN least(greatest(ceil((age - mm.mn) / ((mm.mx - mm.mn) / 10)), 1), 10)
                           ELSE 5 END AS INTEGER) AS age_bin
          FROM ra JOIN (SELECT dataset, min(age) AS mn, max(age) AS mx FROM ra GROUP BY dataset) mm
            ON mm.dataset = ra.dataset) b
    GROUP BY dataset, age_bin""", _AGES)

_SUBJECTS = ["shop_children", "shop_recordings", "shop_subjects", "shop_segments", "shop_sidecars"]
_KEPT_CH = [_KEPT_REC, ("ck", "SELECT * FROM shop_subjects WHERE NOT gone"), ("ca", """
    SELECT ck.*, round(f.a, 2) AS age FROM ck LEFT JOIN (
      SELECT ck.child_id, min(datediff('day', ck.child_dob, rk.date_iso) / 30.4375) AS a
      FROM ck JOIN rk ON rk.child_id = ck.child_id GROUP BY ck.child_id) f ON f.child_id = ck.child_id""")]

ORACLES["subject_summary"] = with_views(_SUBJECTS, """
    SELECT ck.dataset, count(*) AS n_children, count(*) FILTER (WHERE languages NOT LIKE '%;%') AS monolingual,
           count(*) FILTER (WHERE languages LIKE '%;%') AS multilingual,
           count(*) FILTER (WHERE normative = 'Y') AS normative, count(*) FILTER (WHERE normative = 'N') AS non_normative,
           count(*) FILTER (WHERE upper(trim(child_sex)) IN ('M', 'MALE')) AS male,
           count(*) FILTER (WHERE upper(trim(child_sex)) IN ('F', 'FEMALE')) AS female,
           any_value(a.min_age) AS min_age_months, any_value(a.max_age) AS max_age_months,
           coalesce(any_value(l.n), 0) AS languages
    FROM ck
    LEFT JOIN (SELECT c.dataset, round(min(datediff('day', child_dob, date_iso) / 30.4375), 2) AS min_age,
                      round(max(datediff('day', child_dob, date_iso) / 30.4375), 2) AS max_age
               FROM ck c JOIN rk ON rk.child_id = c.child_id GROUP BY c.dataset) a ON a.dataset = ck.dataset
    LEFT JOIN (SELECT dataset, count(DISTINCT trim(x)) AS n
               FROM (SELECT dataset, unnest(string_split(languages, ';')) AS x FROM ck) u GROUP BY dataset) l ON l.dataset = ck.dataset
    GROUP BY ck.dataset""", _KEPT_CH)

ORACLES["child_ages"] = with_views(_SUBJECTS, """
    SELECT dataset, child_id, child_sex, normative, normative_criterion, dob_criterion, dob_accuracy, age AS age_months
    FROM ca""", _KEPT_CH)

_DESC = _KEPT_CH + [("ds", """
    SELECT ca.dataset, CAST(ca.child_id AS VARCHAR) AS child_id,
           coalesce(CAST(CAST(round_even(age, 1) AS DECIMAL(18, 1)) AS VARCHAR), 'N/A') AS child_age,
           coalesce(s.speaker_type, 'N/A') AS speaker_type, s.speaker_id, s.d
    FROM ca JOIN rk r ON r.child_id = ca.child_id JOIN shop_segments s ON s.recording = r.recording
    WHERE s.set_name IN (SELECT set_name FROM shop_sidecars WHERE method = 'manual')""")]


def _bins_sql(over: str) -> list[tuple[str, str]]:
    """Recordings of kept children in 10 equal-width age bins (``over``: the window of a bin's range)."""
    return _KEPT_CH + [
        ("rb", f"""SELECT ca.dataset, ca.age, r.duration, min(age) OVER ({over}) AS mn, (max(age) OVER ({over}) - min(age) OVER ({over})) / 10 AS w
                   FROM rk r JOIN ca ON ca.child_id = r.child_id"""),
        ("bn", """SELECT *, CASE WHEN age IS NULL THEN NULL WHEN w > 0 THEN CAST(least(greatest(ceil((age - mn) / w), 1), 10) AS INTEGER) ELSE 5 END AS b
                  FROM rb"""),
        ("ba", """SELECT dataset, duration, CASE WHEN b IS NULL THEN 'N/A' ELSE lpad(CAST(b AS VARCHAR), 2, '0')
                    || CASE WHEN w > 0 THEN printf(' (%.2f, %.2f]', floor((mn + (b - 1) * w) * 100 + 0.5) / 100, floor((mn + b * w) * 100 + 0.5) / 100) ELSE '' END
                    END AS child_age FROM bn""")]


ORACLES["describe_child_id"] = with_views(_SUBJECTS, """
    SELECT dataset, child_id, CAST(sum(d) AS DOUBLE) / 3600000.0 AS duration_total, count(d) AS "count" FROM ds GROUP BY ALL""", _DESC)
ORACLES["describe_child_age"] = with_views(_SUBJECTS, """
    SELECT dataset, child_age, avg(d) AS duration_mean, count(d) AS "count" FROM ds GROUP BY ALL""", _DESC)
ORACLES["describe_speaker_type"] = with_views(_SUBJECTS, """
    SELECT dataset, speaker_type, round(stddev_samp(d), 6) AS duration_std, count(d) AS "count" FROM ds GROUP BY ALL""", _DESC)
ORACLES["describe_speaker_id"] = with_views(_SUBJECTS, """
    SELECT 'all datasets' AS dataset, speaker_id, count(d) AS "count" FROM ds GROUP BY ALL""", _DESC)
ORACLES["describe_age_bins"] = with_views(_SUBJECTS, """
    SELECT dataset, child_age, CAST(sum(duration) AS DOUBLE) / 3600000.0 AS duration_total, count(duration) AS "count"
    FROM ba GROUP BY ALL""", _bins_sql("PARTITION BY ca.dataset"))
ORACLES["describe_age_bins_pooled"] = with_views(_SUBJECTS, """
    SELECT 'all datasets' AS dataset, child_age, round(avg(duration) / 3600000.0, 6) AS duration_mean FROM ba GROUP BY ALL""",
    _bins_sql(""))

# --- incremental merge ----------------------------------------------------------------

_HALVES = [("old", "SELECT * FROM ev_files WHERE range_onset < 20 * CAST(86400000 AS BIGINT)"),
           ("new", "SELECT * FROM ev_files WHERE range_onset >= 15 * CAST(86400000 AS BIGINT)")]

ORACLES["merge_append"] = with_views(["ev_files"], "SELECT * FROM old UNION SELECT * FROM new", _HALVES)
ORACLES["merge_replace"] = with_views(["ev_files"], """
    SELECT * FROM n UNION SELECT * FROM o WHERE NOT EXISTS (
      SELECT 1 FROM n WHERE n."set" = o."set" AND n.recording_filename = o.recording_filename AND n.day = o.day)""",
    _HALVES + [("n", "SELECT *, range_onset // 86400000 AS day FROM new"), ("o", "SELECT *, range_onset // 86400000 AS day FROM old")])


def _copies(src: str) -> str:
    return f"""
      SELECT 'annotation' AS kind, 'datasets/events/annotations/' || "set" || '/converted/' || annotation_filename AS source,
             'out/annotations/events/' || "set" || '/converted/' || annotation_filename AS target FROM {src}
      UNION SELECT 'sidecar', 'datasets/events/annotations/' || "set" || '/metannots.yml',
             'out/annotations/events/' || "set" || '/metannots.yml' FROM {src}
      UNION SELECT 'standard', 'datasets/events/recordings/converted/standard/' || recording_filename,
             'out/recordings/converted/standard/events/' || recording_filename FROM {src}
      UNION SELECT 'raw', 'datasets/events/recordings/raw/' || raw_filename,
             'out/recordings/raw/events/' || raw_filename FROM {src}"""


ORACLES["copy_manifest"] = with_views(["ev_files"], """
    SELECT * FROM cn WHERE target NOT IN (SELECT target FROM co)""",
    _HALVES + [("cn", _copies("new")), ("co", _copies("old"))])

# --- curation and projections -----------------------------------------------------------

ORACLES["filter_category"] = with_views(_DOC_META, """
    SELECT f.dataset, f.set_name, f.file_key FROM doc_files f
    WHERE EXISTS (SELECT 1 FROM doc_labels l JOIN doc_index i
                    ON i.dataset = l.dataset AND i.set_name = l.set_name AND i."column" = l.label
                   AND i.category IN ('addressee', 'addressee_cols')
                  WHERE l.value IS NOT NULL AND l.dataset = f.dataset AND l.set_name = f.set_name
                    AND l.file_key = f.file_key)""")

ORACLES["gold_sets"] = with_views(["doc_sidecars"], "SELECT dataset, set_name FROM doc_sidecars WHERE method = 'manual'")

_FILE_INDEX = ("fi", """
    SELECT a.recording, a.set_name, a.line, a.range_onset, a.range_offset, r.child_id, r.date_iso, r.duration
    FROM shop_annotations a JOIN rk r ON r.recording = a.recording
    WHERE a.set_name IN (SELECT set_name FROM shop_sidecars WHERE method = 'manual')
      AND r.child_id IN (SELECT child_id FROM shop_children)""")
_SHOP_FI = _SHOP

ORACLES["file_index"] = with_views(_SHOP_FI, "SELECT * FROM fi", [_KEPT_REC, _FILE_INDEX])
ORACLES["filter_children"] = with_views(_SHOP_FI, """
    SELECT recording, set_name, line, child_id FROM fi
    WHERE child_id IN (SELECT child_id FROM shop_children
                       WHERE child_sex = 'BUILDING' AND child_dob >= DATE '1991-01-01')""", [_KEPT_REC, _FILE_INDEX])
ORACLES["propagate_children"] = with_views(_SHOP_FI, """
    SELECT * FROM shop_children WHERE child_id IN (SELECT child_id FROM fi)""", [_KEPT_REC, _FILE_INDEX])

ORACLES["namespace_keys"] = with_views(["shop_recordings", "shop_children"], """
    SELECT r.recording, c.dataset || '/' || r.recording || '.wav' AS recording_filename,
           c.dataset || '_' || r.child_id AS child_id, r.date_iso, r.duration, r.discard
    FROM shop_recordings r JOIN shop_children c ON c.child_id = r.child_id""")

ORACLES["namespace_annotations"] = with_views(_SHOP, """
    SELECT a.recording, a.line, c.dataset || '/' || a.set_name AS "set", a.range_onset, a.range_offset
    FROM shop_annotations a JOIN shop_recordings r ON r.recording = a.recording
    JOIN shop_children c ON c.child_id = r.child_id""")

ORACLES["span_from_name"] = with_views(["ev_files"], f"""
    SELECT seg_id, annotation_filename,
           CAST(regexp_extract(annotation_filename, '{_SPAN_RE}', 1) AS BIGINT) AS span_start,
           CAST(regexp_extract(annotation_filename, '{_SPAN_RE}', 2) AS BIGINT) AS span_end,
           CAST(regexp_extract(annotation_filename, '{_SPAN_RE}', 2) AS BIGINT)
             - CAST(regexp_extract(annotation_filename, '{_SPAN_RE}', 1) AS BIGINT) AS span_ms
    FROM ev_files""")

ORACLES["paths"] = with_views(_SHOP, """
    SELECT recording, line, annotation_path,
           'out/annotations/' || dataset || '/' || set_name || '/converted/' || recording || '_' || range_onset
             || '_' || range_offset || '.csv' AS target_path,
           'datasets/' || dataset || '/recordings/converted/standard/' || recording || '.wav' AS wav_path,
           dataset AS dataset_of_set, 'benchmarking' AS experiment
    FROM si WHERE dataset IS NOT NULL""", [("si", _SPLIT_INPUT)])

ORACLES["align_drop_null"] = with_views(["doc_labels"], "SELECT dataset, set_name, file_key, label, value FROM doc_labels")

ORACLES["select_datasets"] = with_views(["docs_index"], """
    SELECT key, dataset, set_name FROM docs_index WHERE dataset IN ('de', 'es')""")

# --- flagship -------------------------------------------------------------------------

_FLAG = [
    ("kept", """SELECT * FROM ev_files f WHERE EXISTS (
                  SELECT 1 FROM ev_labels l WHERE l.seg_id = f.seg_id AND l.set_name = f."set"
                    AND l.label = 'speaker_type' AND l.value IS NOT NULL)
                  AND f."set" NOT IN ('signup', 'purchase')
                  AND f.recording_filename NOT IN (SELECT 'u' || user_id || '.wav' FROM events WHERE user_id % 10 IN (3, 7))"""),
    ("ann", """SELECT 'events/' || "set" AS "set", 'events/' || recording_filename AS recording_filename,
                      raw_filename, time_seek, range_onset, range_offset, annotation_filename, seg_id FROM kept"""),
    ("rec", """SELECT 'events/' || recording_filename AS recording_filename, duration, 'events_' || child_id AS child_id
               FROM ev_file_recordings WHERE recording_filename IN (SELECT recording_filename FROM kept)"""),
    ("c", clipped_sql("ann", "rec", "recording_filename", "range_onset", "range_offset", 0)),
] + support_sql("c", "recording_filename", "s", "e") + [
    ("clips", """SELECT k AS recording_filename, cs, ce,
                        regexp_replace(k, '\\.wav$', '') || '-' || cs || 'to' || ce || '.wav' AS clip_filename
                 FROM islands"""),
    ("asg", """SELECT a.*, c.cs, c.ce, c.clip_filename FROM ann a JOIN clips c
               ON c.recording_filename = a.recording_filename AND c.cs <= a.range_onset AND a.range_offset <= c.ce"""),
]

ORACLES["create_dataset"] = with_views(["ev_files", "ev_file_recordings", "ev_labels"], """
    SELECT DISTINCT seg_id, "set", clip_filename AS recording_filename, range_onset - cs AS range_onset,
           range_offset - cs AS range_offset, CAST(0 AS BIGINT) AS time_seek,
           regexp_replace(regexp_replace(clip_filename, '^.*/', ''), '\\.wav$', '') || '_' || (range_onset - cs)
             || '_' || (range_offset - cs) || '.csv' AS annotation_filename,
           regexp_replace(regexp_replace(clip_filename, '^.*/', ''), '\\.wav$', '') || '.its' AS raw_filename
    FROM asg""", _FLAG)

ORACLES["create_dataset_recordings"] = with_views(["ev_files", "ev_file_recordings", "ev_labels"], """
    SELECT DISTINCT c.clip_filename AS recording_filename, r.child_id, CAST(c.ce - c.cs AS BIGINT) AS duration,
           'benchmarking' AS experiment
    FROM rec r JOIN clips c ON c.recording_filename = r.recording_filename""", _FLAG)

# --- plan-level -----------------------------------------------------------------------------

_SAME_CHILD = [("si", _SPLIT_INPUT)] + _entity_ctes(
    "SELECT child_id, dataset, CAST(sum(duration_ms) AS BIGINT) AS w FROM si GROUP BY child_id, dataset",
    "coalesce(CAST(child_id AS VARCHAR), chr(0)) || chr(1) || coalesce(dataset, chr(0))", "md5(concat_ws(':', '0', child_id, dataset))")

ORACLES["split_same_child"] = _with_recursive(["shop_annotations", "shop_recordings", "shop_children"], """
    SELECT DISTINCT si.recording, si.set_name, si.line, si.child_id, si.dataset, si.range_onset, si.range_offset,
           si.duration_ms, si.annotation_path,
           regexp_replace(si.recording_path, '\\.[^./]*$', '') || '.wav' AS recording_path, es.split
    FROM si JOIN es ON es.e = coalesce(CAST(si.child_id AS VARCHAR), chr(0)) || chr(1) || coalesce(si.dataset, chr(0))""", _SAME_CHILD)

ORACLES["validation_report"] = " UNION ALL ".join(
    f"({ORACLES[k]})" for k in ["check_sidecar_values", "check_index_columns", "check_index_sets",
                                "check_missing_flag", "check_false_flag", "check_sidecar_missing",
                                "check_index_fields"])

ORACLES["clip_orphans"] = with_views(["shop_annotations", "shop_recordings"], """
    SELECT recording, set_name, line, range_onset, range_offset FROM shop_annotations a
    WHERE NOT EXISTS (SELECT 1 FROM rk WHERE rk.recording = a.recording)""", [_KEPT_REC])
ORACLES["propagate_recordings"] = with_views(_SHOP_FI, """
    SELECT recording, child_id, date_iso, duration FROM shop_recordings WHERE recording IN (SELECT recording FROM fi)""",
    [_KEPT_REC, _FILE_INDEX])
ORACLES["propagate_annotations"] = with_views(_SHOP_FI, """
    SELECT * FROM shop_annotations a WHERE EXISTS (SELECT 1 FROM fi WHERE fi.recording = a.recording
      AND fi.set_name = a.set_name AND fi.line = a.line)""", [_KEPT_REC, _FILE_INDEX])

ORACLES["overall_std"] = with_views(_SHOP, """
    SELECT child_sex, round(stddev_samp(d), 6) AS duration_std, count(d) AS "count" FROM segs GROUP BY ALL""", _SEGS)

ORACLES["filter_sidecars"] = with_views(["doc_sidecars"], """
    SELECT dataset, set_name FROM doc_sidecars WHERE method = 'manual' AND has_speaker_type = 'Y'""")

ORACLES["split_curated"] = with_views(["ev_files", "ev_file_recordings", "ev_labels"], """
    SELECT DISTINCT seg_id, "set", child_id, duration_ms, annotation_path, recording_path, split FROM ws""",
    [_FLAG[0],
     ("si", """SELECT k.seg_id, k."set" AS set_name, k."set", r.child_id, k.range_offset - k.range_onset AS duration_ms,
                      'datasets/events/annotations/' || k."set" || '/converted/' || k.annotation_filename AS annotation_path,
                      'datasets/events/recordings/converted/standard/'
                        || regexp_replace(k.recording_filename, '\\.[^./]*$', '') || '.wav' AS recording_path
               FROM kept k LEFT JOIN ev_file_recordings r ON r.recording_filename = k.recording_filename"""),
     ("ws", _wsplit("set_name", 0, (700, 200, 100), key="seg_id", weight="duration_ms", src="si"))])

ORACLES["distribution_recordings"] = with_views(["shop_children", "shop_recordings"], """
    SELECT c.dataset, coalesce(CAST(c.child_sex AS VARCHAR), 'N/A') AS child_sex,
           avg(r.duration) / 3600000.0 AS duration_mean, count(r.duration) AS "count"
    FROM rk r JOIN shop_children c ON c.child_id = r.child_id GROUP BY ALL""", [_KEPT_REC])

ORACLES["split_created"] = with_views(["ev_files", "ev_file_recordings", "ev_labels"], """
    SELECT seg_id, dataset, child_id, duration_ms, split FROM ws""",
    _FLAG + [
        ("si", """SELECT DISTINCT a.seg_id, split_part(a."set", '/', 1) AS dataset, r.child_id,
                         a.range_offset - a.range_onset AS duration_ms
                  FROM asg a JOIN rec r ON r.recording_filename = a.recording_filename"""),
        ("ws", _wsplit("dataset", 0, (800, 100, 100), key="seg_id", weight="duration_ms", src="si"))])

ORACLES["create_dataset_copies"] = with_views(["ev_files", "ev_file_recordings", "ev_labels"], """
    SELECT 'annotation' AS kind, 'datasets/events/annotations/' || "set" || '/converted/' || annotation_filename AS source,
           './annotations/events/' || "set" || '/converted/' || annotation_filename AS target FROM kept
    UNION SELECT 'sidecar', 'datasets/events/annotations/' || "set" || '/metannots.yml',
           './annotations/events/' || "set" || '/metannots.yml' FROM kept
    UNION SELECT 'raw', 'datasets/events/recordings/raw/' || recording_filename,
           './recordings/raw/events/' || recording_filename FROM kept
    UNION SELECT 'standard', 'datasets/events/recordings/converted/standard/'
             || regexp_replace(recording_filename, '\\.[^./]*$', '') || '.wav',
           './recordings/converted/standard/events/' || regexp_replace(recording_filename, '\\.[^./]*$', '') || '.wav'
      FROM kept""", [_FLAG[0]])

ORACLES["interval_support_batches"] = ORACLES["interval_support"]

_NULL_WORDS = ", ".join(f"'{w}'" for w in NULL_WORDS)


def _cell(col: str) -> str:
    return f"CASE WHEN trim({col}) IN ({_NULL_WORDS}) THEN NULL ELSE {col} END"


ORACLES["scan_index_files"] = f"""
    SELECT lang AS dataset, CAST(doc_id AS VARCHAR) AS doc_id, {_cell('source')} AS source, n_chars AS duration, {_cell('text')} AS notes
    FROM documents"""
ORACLES["scan_segment_files"] = f"""
    WITH t AS (SELECT 'c' || conv_id % 4 AS dataset, role AS "set", conv_id * 100000 + turn AS segment_onset,
                      CAST(length(text) AS BIGINT) AS segment_offset, text FROM conversations WHERE conv_id % 4 <> 1)
    SELECT dataset, "set", segment_onset, segment_offset, 'transcription' AS label, {_cell('text')} AS value FROM t
    UNION ALL
    SELECT dataset, "set", segment_onset, segment_offset, 'speaker_type', CASE WHEN segment_offset % 2 = 0 THEN NULL ELSE "set" END FROM t
    WHERE "set" <> 'user'"""


def _events_where(sql: str, cond: str) -> str:
    """``sql`` over the events that fulfil ``cond``."""
    return sql.replace("FROM events", f"FROM (SELECT * FROM events WHERE {cond}) events")


_OLD, _NEW = "event_id % 3 <> 0", "event_type IN ('view', 'click') AND event_id % 5 <> 0"
ORACLES["create_dataset_merged"] = f"""
    WITH old AS ({_events_where(ORACLES['create_dataset'], _OLD)}), new AS ({_events_where(ORACLES['create_dataset'], _NEW)})
    SELECT * FROM new UNION SELECT * FROM old WHERE "set" NOT IN (SELECT "set" FROM new)"""
ORACLES["create_dataset_merged_recordings"] = f"""
    WITH old AS ({_events_where(ORACLES['create_dataset_recordings'], _OLD)}), new AS ({_events_where(ORACLES['create_dataset_recordings'], _NEW)})
    SELECT * FROM new UNION SELECT * FROM old WHERE child_id NOT IN (SELECT child_id FROM new)"""

_RAW_JOBS = with_views(
    ["ev_files", "ev_file_recordings"],
    """SELECT DISTINCT 'raw' AS version, 'recordings/raw/' || k AS source, cs AS "start", ce AS "end",
              'recordings/raw/' || regexp_replace(k, '\\.[^./]*$', '') || '-' || cs || 'to' || ce || '.wav' AS output FROM islands""",
    [("c", clipped_sql("ev_files", "ev_file_recordings", "recording_filename", "range_onset", "range_offset", 0))]
    + support_sql("c", "recording_filename", "s", "e"))
ORACLES["cut_manifest_existing"] = f"""
    WITH jobs AS ({_RAW_JOBS}), done AS ({_events_where(_RAW_JOBS, _OLD)})
    SELECT * FROM jobs WHERE output NOT IN (SELECT output FROM done)"""

ORACLES["label_profile_replaced"] = ORACLES["label_profile"]

_AXES = {"child_id": "CAST(child_id AS VARCHAR)", "child_age": "child_age", "child_sex": "child_sex", "speaker_type": "speaker_type", "speaker_id": "speaker_id"}
_EACH_AXIS = " UNION ALL ".join(f"SELECT dataset, '{a}' AS axis, coalesce(CAST({c} AS VARCHAR), 'N/A') AS x, d FROM dx" for a, c in _AXES.items())
ORACLES["describe_all_axes"] = with_views(_SUBJECTS, """
    SELECT dataset, axis, x, n AS "count", CAST(t AS DOUBLE) / 3600000.0 AS duration_total, round(m, 6) AS duration_mean,
           round(s, 6) AS duration_std, CAST(NULL AS DOUBLE) AS pooled_std FROM per
    UNION ALL
    SELECT 'all datasets', axis, x, count(d), CAST(sum(d) AS DOUBLE) / 3600000.0, round(avg(d), 6), round(stddev_samp(d), 6),
           (SELECT round(sqrt(sum(p.s * p.s * p.n) / sum(p.n)), 6) FROM per p WHERE p.axis = ea.axis AND p.x = ea.x)
    FROM ea GROUP BY axis, x""", _DESC + [
    ("dx", "SELECT ds.*, ss.child_sex FROM ds JOIN shop_subjects ss ON CAST(ss.child_id AS VARCHAR) = ds.child_id"), ("ea", _EACH_AXIS),
    ("per", "SELECT dataset, axis, x, count(d) AS n, sum(d) AS t, avg(d) AS m, stddev_samp(d) AS s FROM ea GROUP BY ALL")])

ORACLES["cut_recordings"] = """
    WITH d AS (SELECT 'd' || doc_id AS name, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents WHERE text IS NOT NULL),
    c AS (SELECT name, h, n - n % 2 AS n, v.s, v.e FROM d, LATERAL (VALUES (10, 60), (100, 100 + n // 4), (10000000, 10000005)) v(s, e)),
    b AS (SELECT *, least(2 * s, n) AS first, least(2 * e, n) AS last FROM c)
    SELECT name || '-' || s || 'to' || e || '.wav' AS output, CAST(last - first AS BIGINT) AS n_bytes,
           md5(substr(h, 2 * first + 1, 2 * (last - first))) AS samples_md5 FROM b"""
