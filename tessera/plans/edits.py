"""Queries of edits, removals, review answers, source order and nested leaves."""

from pyspark.sql import functions as F

from tessera.functions.text import first_source
from tessera.operators import edits as E
from tessera.operators import ledger
from tessera.operators.leaves import flatten_leaves
from tessera.plans.base import query


def _rows(read):
    return read("documents").select("doc_id", F.array_distinct(F.array("lang", "source")).alias("tags"))


def _edits(read):
    """Labels as edits: toxic replaces the list, bad quality removes a language, good quality adds two tags."""
    j = read("labels").join(read("documents").select("doc_id", "lang"), "doc_id")
    of = lambda test, seq, op, tag: F.when(test, F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(op).alias("op"), tag.alias("tag")))
    each = F.array_compact(F.array(of(F.col("toxic") == 1, 1, "set", F.lit("flagged")), of(F.col("quality") == 0, 2, "remove", F.col("lang")), of(F.col("quality") == 1, 3, "add", F.lit("Good_Text")), of(F.col("quality") == 1, 4, "add", F.lit("flagged"))))
    return j.select("doc_id", F.explode(each).alias("e")).select("doc_id", "e.*")


_FLAGS = """WITH e AS (SELECT doc_id, bool_or(toxic = 1) AS s, bool_or(quality = 0) AS r, bool_or(quality = 1) AS a FROM labels GROUP BY 1),
d AS (SELECT doc_id, lang, [lang, source] AS was, coalesce(s, false) AS s, coalesce(r, false) AS r, coalesce(a, false) AS a FROM documents LEFT JOIN e USING (doc_id)),
k AS (SELECT *, CASE WHEN s THEN ['flagged'] ELSE was END AS base FROM d),
n AS (SELECT *, CASE WHEN r THEN list_filter(base, lambda x: x <> lang) ELSE base END AS kept FROM k),
o AS (SELECT *, CASE WHEN NOT a THEN kept WHEN list_contains(kept, 'flagged') THEN kept || ['good text'] ELSE kept || ['good text', 'flagged'] END AS tags FROM n)
"""


@query(_FLAGS + "SELECT doc_id, array_to_string(tags, ', ') AS line FROM o")
def edit_lines(read):
    """Lines after a batch of edits; their tags are normalised, those of the rows already are."""
    edited, _ = E.apply_edits(_rows(read), _edits(read), _edits(read).select("doc_id", "tag").limit(0), "doc_id")
    return edited.select("doc_id", F.array_join("tags", ", ").alias("line"))


@query(_FLAGS + "SELECT doc_id, lang AS tag FROM d WHERE r")
def edit_ledger(read):
    """The ledger after the same batch."""
    return E.apply_edits(_rows(read), _edits(read), _edits(read).select("doc_id", "tag").limit(0), "doc_id")[1]


@query(_FLAGS + "SELECT doc_id, unnest(list_filter(was, lambda x: NOT list_contains(tags, x))) AS tag FROM o UNION SELECT doc_id, lang FROM d WHERE r")
def removed_by_hand(read):
    """What a new wash may not bring back after the same batch."""
    rows, edits = _rows(read), _edits(read)
    now, ledger = E.apply_edits(rows, edits, edits.select("doc_id", "tag").limit(0), "doc_id")
    return E.removed_tags(rows, now, ledger, "doc_id")


@query("SELECT page_id, CASE WHEN regexp_extract(html, 'src=\"([^\"]+)\"', 1) <> '' THEN regexp_extract(html, 'src=\"([^\"]+)\"', 1) WHEN starts_with(url, 'http') THEN url WHEN regexp_extract(html, 'href=\"([^\"]+)\"', 1) <> '' THEN regexp_extract(html, 'href=\"([^\"]+)\"', 1) ELSE '' END AS source FROM pages")
def source_coalesce(read):
    """The first usable url of a page: an embedded file, the page itself if http, a link."""
    part = lambda name: F.regexp_extract("html", f'{name}="([^"]+)"', 1)
    return read("pages").select("page_id", first_source(part("src"), F.col("url"), part("href")).alias("source"))


@query("SELECT event_id, 'id' AS path, CAST(event_id AS VARCHAR) AS value FROM events UNION ALL SELECT event_id, 'in.props.k', json_extract_string(props, '$.k') FROM events UNION ALL SELECT event_id, 'in.kind', event_type FROM events")
def leaf_flatten(read):
    """Leaves of three levels, by dotted key."""
    nested = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"in":{"kind":"'), "event_type", F.lit('","props":'), "props", F.lit("}}"))
    return flatten_leaves(read("events").select("event_id", nested.alias("json")), "event_id", "json")


@query("WITH e AS (SELECT user_id, event_id, ts, event_type = 'signup' AS closes, json_extract_string(props, '$.k') AS bucket FROM events WHERE event_type IN ('error', 'signup') AND user_id IS NOT NULL), g AS (SELECT *, coalesce(sum(closes::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gap FROM e), f AS (SELECT user_id, gap, min(ts) FILTER (WHERE NOT closes) AS \"at\", last(bucket ORDER BY ts, event_id) FILTER (WHERE NOT closes) AS bucket, max(ts) FILTER (WHERE closes) AS restored_at FROM g GROUP BY 1, 2) SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY gap) AS entry, \"at\", bucket, restored_at FROM f WHERE \"at\" IS NOT NULL")
def removal_ledger(read):
    """Errors remove a user, the next signup restores it; the bucket is the last one named while the entry was open."""
    kind = F.when(F.col("event_type") == "error", ledger.REMOVE).when(F.col("event_type") == "signup", ledger.RESTORE)
    e = read("events").select("user_id", kind.alias("kind"), "ts", "event_id", F.get_json_object("props", "$.k").alias("bucket"))
    return ledger.entries(e, "user_id", "kind", "ts", ["ts", "event_id"], ["bucket"], "event_id")


STAGES = ["signup", "view", "click", "purchase"]


@query("WITH e AS (SELECT user_id, event_id, event_type AS stage, list_position(['signup', 'view', 'click', 'purchase'], event_type) - 1 AS pos, CASE WHEN json_extract_string(props, '$.k') = '0' THEN 'stale' ELSE 'done' END AS status FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL), l AS (SELECT user_id, stage, pos, arg_max(status, event_id) AS last, max(event_id) AS done, max(event_id) FILTER (WHERE status <> 'stale') AS ran FROM e GROUP BY 1, 2, 3), b AS (SELECT l.user_id, l.pos, arg_min(x.stage, x.pos) AS stale_after FROM l JOIN l x ON x.user_id = l.user_id AND x.pos < l.pos AND x.ran > l.done GROUP BY 1, 2) SELECT user_id, stage, pos, CASE WHEN stale_after IS NULL THEN last ELSE 'stale' END AS status, stale_after FROM l LEFT JOIN b USING (user_id, pos)")
def stage_table(read):
    """Each user's stages with their status, and the first earlier stage that ran after them."""
    status = F.when(F.get_json_object("props", "$.k") == "0", "stale").otherwise("done")
    log = read("events").select("user_id", "event_type", "event_id", status.alias("status"))
    return ledger.stage_table(log, STAGES, "user_id", "event_type", "status", ["event_id"])
