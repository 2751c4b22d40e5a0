"""Queries of assets: listings, pairing, screening, reports, duplicates, families, diffs."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions import text as T
from tessera.operators import dedup as D
from tessera.operators import diff
from tessera.operators import families as Y
from tessera.operators import lookup as L
from tessera.operators import numbering as N
from tessera.operators import reports as P
from tessera.operators import reuse
from tessera.operators import screening as S
from tessera.operators.components import connected_components, spanning
from tessera.plans.base import query
from tessera.storage import materialize

HOST = "regexp_extract(url, '://([^/?#]*)', 1)"


@query(f"SELECT page_id, bucket, dense_rank() OVER (ORDER BY bucket) AS rank FROM (SELECT page_id, {HOST} AS bucket FROM pages)")
def bucket_assign(read):
    p = read("pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("bucket"))
    return N.bucket_ranks(p, "bucket").select("page_id", "bucket", "rank")


@query("WITH c AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u FROM pages), k AS (SELECT *, CASE WHEN u LIKE '%.html' THEN 'image' WHEN u LIKE '%/' THEN 'other' ELSE 'sidecar' END AS kind, lower(regexp_extract(u, '([^/]+)/?$', 1)) AS name FROM c) SELECT page_id, kind, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY u, page_id) > 1 THEN name || '__' || row_number() OVER (PARTITION BY name ORDER BY u, page_id) ELSE name END AS name FROM k")
def import_classify(read):
    u = F.regexp_replace("url", "[?#].*$", "")
    kind = S.first_class([("image", u.endswith(".html")), ("other", u.endswith("/"))], "sidecar")
    k = read("pages").select("page_id", u.alias("u"), kind.alias("kind"), F.lower(F.regexp_extract(u, "([^/]+)/?$", 1)).alias("name"))
    return N.distinct_names(k, "name", ["u", "page_id"], lambda n, i: N.serial(n, i, "__")).select("page_id", "kind", "name")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def sidecar_join(read):
    return L.attach(read("documents").select("doc_id"), read("labels"), "doc_id", "quality", -1)


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'orphan' WHEN l.doc_id IS NULL THEN 'missing' WHEN l.toxic = 1 THEN 'empty' ELSE 'ok' END AS status FROM documents d FULL JOIN (SELECT doc_id, toxic FROM labels UNION ALL SELECT item_id + 1000000000, 0 FROM benchmark) l ON d.doc_id = l.doc_id")
def pairing(read):
    """Documents and labels; the benchmark's items are labels without a document."""
    notes = read("labels").select("doc_id", "toxic").union(read("benchmark").select(F.col("item_id") + 1000000000, F.lit(0)))
    return L.pair_status(read("documents"), notes, "doc_id", F.col("toxic") == 1)


@query("SELECT origin, count(*) AS n FROM (SELECT CASE WHEN c_custkey IS NOT NULL THEN 'A+' WHEN o_orderkey IS NOT NULL THEN 'A' ELSE 'none' END AS origin FROM lineitem LEFT JOIN (FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey LEFT JOIN (FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey) GROUP BY 1")
def backlookup(read):
    o, c = read("orders").where("o_orderstatus <> 'P'"), read("customer").where("c_acctbal > 0")
    return L.trace_origin(read("lineitem").select("l_orderkey"), "l_orderkey", o, "o_orderkey", "o_custkey", c, "c_custkey").groupBy("origin").agg(F.count("*").alias("n"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN n_chars < 300 THEN 'low-res' END, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'language' END, CASE WHEN NOT contains(text, chr(10)) THEN 'tiny-file' END], lambda x: x IS NOT NULL), '|') AS reasons, coalesce(list_filter([CASE WHEN n_chars < 300 THEN 'low-res' END, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'language' END, CASE WHEN NOT contains(text, chr(10)) THEN 'tiny-file' END], lambda x: x IS NOT NULL)[1], 'keep') AS decision FROM documents")
def screen(read):
    rules = {"low-res": F.col("n_chars") < 300, "language": ~F.col("lang").isin("en", "de", "fr"), "tiny-file": ~F.contains("text", F.lit("\n"))}
    found = S.reasons(rules)
    return read("documents").select("doc_id", F.array_join(found, "|").alias("reasons"), S.decide(found).alias("decision"))


@query("WITH d AS (SELECT doc_id, md5(text) AS h, md5(regexp_replace(text, '[^a-zA-Z]+', '', 'g')) AS g FROM documents), c AS (SELECT doc_id, h, g FROM d SEMI JOIN labels USING (doc_id) UNION ALL SELECT item_id + 1000000000, md5(text), md5(regexp_replace(text, '[^a-zA-Z]+', '', 'g')) FROM benchmark), a AS (SELECT h, min(doc_id) AS ref, count(*) AS n FROM c GROUP BY 1), b AS (SELECT g, min(doc_id) AS ref, count(*) AS n FROM c GROUP BY 1) SELECT d.doc_id, CASE WHEN a.n = 1 THEN 'md5' WHEN a.n > 1 THEN 'ambiguous' WHEN b.n = 1 THEN 'letters' WHEN b.n > 1 THEN 'ambiguous' ELSE 'none' END AS by, CASE WHEN a.n = 1 THEN a.ref WHEN a.n IS NULL AND b.n = 1 THEN b.ref END AS ref FROM d LEFT JOIN a USING (h) LEFT JOIN b USING (g)")
def cascade_match(read):
    """Documents against a catalog of the labelled ones and the benchmark: by digest, then by the digest of their letters."""
    keys = lambda df, i: df.select(i.alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("h"), F.md5(F.regexp_replace("text", "[^a-zA-Z]+", "").cast("binary")).alias("g"))
    d = keys(read("documents"), F.col("doc_id"))
    catalog = d.join(read("labels").select("doc_id"), "doc_id", "left_semi").union(keys(read("benchmark"), F.col("item_id") + 1000000000))
    return L.cascade_match(d, catalog, "doc_id", [("md5", "h"), ("letters", "g")]).select("doc_id", "by", "ref")


#: Embeddings with near copies: for every fifth vector one more, its first vec_id % 4 elements negated.
COPIES = "WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT * FROM v UNION ALL SELECT vec_id + 1000000, label, list_transform(e, lambda x, i: CASE WHEN i <= vec_id % 4 THEN -x ELSE x END) FROM v WHERE vec_id % 5 = 0) "


def planted(read):
    v = read("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    copies = v.where("vec_id % 5 = 0").select((F.col("vec_id") + 1000000).alias("vec_id"), "label", F.transform("e", lambda x, i: F.when(i < F.col("vec_id") % 4, -x).otherwise(x)).alias("e"))
    return v.union(copies)


BITS = "c AS (SELECT vec_id, array_to_string(list_transform(e, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT AS b, label, e FROM p) "


@query(COPIES + ", " + BITS + "SELECT x.vec_id AS a, y.vec_id AS b, bit_count(xor(x.b, y.b))::BIGINT AS distance FROM c x JOIN c y ON x.vec_id < y.vec_id AND bit_count(xor(x.b, y.b)) <= 4")
def hamming_pairs(read):
    return D.hamming_pairs(planted(read).select("vec_id", D.sign_bits(F.col("e")).alias("code")), "vec_id", "code", 4)


SIG = COPIES + ", m AS (SELECT vec_id, label, list_transform(e, lambda x: x - list_avg(e)) AS e FROM p), s AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM m) "


@query(SIG + "SELECT x.vec_id AS a, y.vec_id AS b, round(list_inner_product(x.e, y.e), 6) AS corr FROM s x JOIN s y ON x.vec_id < y.vec_id AND x.label <> y.label AND list_inner_product(x.e, y.e) >= 0.4")
def corr_pairs(read):
    return D.correlated_pairs(planted(read), "vec_id", "e", "label", 0.4).withColumn("corr", F.round("corr", 6))


@query(SIG + "SELECT vec_id, round(e[1], 9) AS first, round(list_inner_product(e, e), 6) AS norm FROM s")
def l2_signature(read):
    s = planted(read).select("vec_id", D.signature(F.col("e")).alias("e"))
    return s.select("vec_id", F.round(F.get("e", 0), 9).alias("first"), F.round(D.dot(F.col("e"), F.col("e")), 6).alias("norm"))


PAIR = COPIES + ", q AS (SELECT x.vec_id, list_transform(x.e, lambda v: 127 * v + 128) AS a, list_transform(y.e, lambda v: 127 * v + 128) AS b FROM p x JOIN p y ON y.vec_id = x.vec_id + 1000000), d AS (SELECT *, list_transform(list_zip(a, b), lambda z: abs(z[1] - z[2])) AS d, list_avg(a) AS ma, list_avg(b) AS mb FROM q), z AS (SELECT *, ((2 * ma * mb + 6.5025) * (2 * (list_inner_product(a, b) / 64 - ma * mb) + 58.5225)) / ((ma * ma + mb * mb + 6.5025) * (list_inner_product(a, a) / 64 - ma * ma + list_inner_product(b, b) / 64 - mb * mb + 58.5225)) AS ssim, list_avg(d) AS mean, list_max(d) AS most, list_max(list_transform(range(8), lambda i: list_avg(d[i * 8 + 1:i * 8 + 8]))) AS block FROM d) "


def pixel_pairs(read):
    px = planted(read).select("vec_id", F.transform("e", lambda v: v * 127 + 128).alias("a"))
    other = px.select((F.col("vec_id") - 1000000).alias("vec_id"), F.col("a").alias("b"))
    return px.join(other, "vec_id").select("vec_id", D.ssim(F.col("a"), F.col("b")).alias("ssim"), D.differences(F.col("a"), F.col("b")).alias("d"))


@query(PAIR + "SELECT vec_id, round(ssim, 6) AS ssim FROM z")
def ssim_pairs(read):
    return pixel_pairs(read).select("vec_id", F.round("ssim", 6).alias("ssim"))


@query(PAIR + "SELECT vec_id, round(mean, 6) AS mean, round(most, 6) AS most, round(block, 6) AS block FROM z")
def local_diff(read):
    return pixel_pairs(read).select("vec_id", F.round("d.mean", 6).alias("mean"), F.round("d.max", 6).alias("most"), F.round("d.block", 6).alias("block"))


@query(PAIR + "SELECT vec_id, ssim >= 0.97 AND mean <= 2 AND most <= 60 AND block <= 8 AS same FROM z")
def same_item(read):
    return pixel_pairs(read).select("vec_id", ((F.col("ssim") >= 0.97) & (F.col("d.mean") <= 2) & (F.col("d.max") <= 60) & (F.col("d.block") <= 8)).alias("same"))


@query()
def phash(read):
    return D.phash(planted(read), "vec_id", "e")


@query("SELECT doc_id, unnest(list_distinct(list_transform(range(0, greatest(1, n_chars), 768), lambda s: least(s, greatest(0, n_chars - 1024))))) AS origin FROM documents")
def tile_plan(read):
    """Tiles of 1024 characters that overlap by 256; the last one is moved back to the end."""
    at = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1).cast("long"), F.col("n_chars")) - 1, F.lit(768).cast("long")), lambda s: F.least(s, F.greatest(F.lit(0).cast("long"), F.col("n_chars") - 1024)))
    return read("documents").select("doc_id", F.explode(F.array_distinct(at)).alias("origin"))


@query()
def nms(read):
    li = read("lineitem")
    x, y = (F.col("l_partkey") % 90).cast("double"), (F.col("l_suppkey") % 90).cast("double")
    boxes = li.select((F.col("l_orderkey") % 997).alias("image"), F.col("l_returnflag").alias("label"), F.xxhash64("l_orderkey", "l_linenumber", "l_partkey").alias("box"), (F.col("l_extendedprice") / 100000).alias("score"), x.alias("x1"), y.alias("y1"), (x + F.col("l_quantity")).alias("x2"), (y + F.col("l_quantity")).alias("y2"))
    least = boxes.select("label").distinct().withColumn("score", F.when(F.col("label") == "N", 0.2).otherwise(0.25))
    return D.suppress(boxes, least=least)


@query("SELECT md5(text) AS h, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dups(read):
    return P.exact_groups(read("documents"), "doc_id", "text")


@query("WITH f AS (SELECT source, doc_id, row_number() OVER (PARTITION BY md5(text), n_chars ORDER BY source, doc_id) AS r FROM documents) SELECT source, count(*) FILTER (WHERE r = 1) AS uniq, count(*) FILTER (WHERE r > 1) AS dup FROM f GROUP BY 1 HAVING count(*) FILTER (WHERE r = 1) > 0")
def bucket_dedup(read):
    d = read("documents").withColumn("h", F.md5(F.col("text").cast("binary")))
    return P.unique_by_bucket(d, "source", "doc_id", ["h", "n_chars"])


@query("SELECT source, lang, count(*) AS n FROM documents WHERE source NOT IN ('src1') GROUP BY 1, 2")
def bucket_counts(read):
    return P.bucket_counts(read("documents"), ["source", "lang"], F.col("source") == "src1")


@query("SELECT source, count(*) AS n, count(*) FILTER (WHERE l.doc_id IS NULL) AS missing, min(n_chars) AS low, max(n_chars) AS high, round(avg(n_chars), 1) AS mean, count(*) FILTER (WHERE n_chars < 300) AS under FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def health(read):
    j = read("documents").select("doc_id", "source", "n_chars").join(read("labels").select("doc_id", F.lit(True).alias("l")), "doc_id", "left")
    return P.caption_health(j, "source", "n_chars", F.col("l"), 300)


@query("SELECT source, lang, count(*) AS n, count(*) FILTER (WHERE regexp_replace(text, '[^a-zA-Z]', '', 'g') = '') AS emptied FROM documents GROUP BY 1, 2")
def origin_counts(read):
    return P.bucket_counts(read("documents"), ["source", "lang"], emptied=~F.col("text").rlike("[a-zA-Z]"))


@query("SELECT s.event_type, count(e.event_id) AS queried, coalesce(count(e.event_id) FILTER (WHERE value > 50) / nullif(count(e.event_id), 0), 0) AS rate FROM (VALUES ('click'), ('error'), ('view'), ('never')) s(event_type) LEFT JOIN events e USING (event_type) GROUP BY 1")
def hit_rate(read):
    return P.hit_rates(read("events"), "event_type", "event_id", F.col("value") > 50, ["click", "error", "view", "never"])


@query("SELECT 'diff' || k AS bucket, count(*) AS families, max(greatest(1, round_even(8 / sqrt(k), 0)))::BIGINT AS repeats FROM (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) GROUP BY 1")
def group_weights(read):
    return P.group_weights(read("orders"), "o_custkey", "diff", 8)


@query("WITH b AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), t AS (SELECT max(n) FILTER (WHERE source <> 'src1') AS big FROM b) SELECT source, n, CASE WHEN source = 'src1' THEN least(8, greatest(CASE WHEN n < 20 THEN 10 WHEN n < 60 THEN 5 WHEN n < 200 THEN 2 ELSE 1 END, ceil(big / n)))::BIGINT ELSE 1 END AS repeats FROM b, t")
def sample_plan(read):
    return P.balance_plan(read("documents"), "source", F.col("source") == "src1", [(20, 10), (60, 5), (200, 2)], 8)


@query("WITH j AS (SELECT source, doc_id, l.doc_id IS NOT NULL AS marked FROM documents d LEFT JOIN labels l USING (doc_id)), s AS (SELECT source FROM j GROUP BY 1 HAVING avg(marked::INT) >= 0.4) SELECT source, doc_id FROM j SEMI JOIN s USING (source) WHERE NOT marked")
def majority_gap(read):
    j = read("documents").select("source", "doc_id").join(read("labels").select("doc_id", F.lit(True).alias("m")), "doc_id", "left")
    return P.majority_gap(j, "source", F.col("m"), 0.4).select("source", "doc_id")


@query("WITH b AS (SELECT source, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY 1) SELECT source, bytes, CASE WHEN bytes >= 1048576 THEN 'MB' WHEN bytes >= 1024 THEN 'KB' ELSE 'B' END AS unit FROM b")
def bytes_report(read):
    return P.bytes_report(read("documents"), "source", "n_chars")


@query("SELECT coalesce(c_nationkey, -1) AS dataset, count(DISTINCT user_id) AS members, coalesce(array_to_string(list_sort(list(DISTINCT event_type) FILTER (WHERE value > 20)), '|'), '') AS stages FROM events LEFT JOIN customer ON user_id = c_custkey GROUP BY 1")
def overview(read):
    """Users by the nation of the customer of the same number; users that are no customer are dataset -1."""
    j = read("events").join(read("customer"), F.col("user_id") == F.col("c_custkey"), "left").withColumn("dataset", F.coalesce("c_nationkey", F.lit(-1)))
    return P.overview(j, "dataset", "user_id", F.when(F.col("value") > 20, F.col("event_type")))


@query("SELECT md5(text) AS h, arg_max(doc_id, {'l': length(lang || source), 'n': n_chars, 'i': -doc_id}) AS keeper, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_keeper(read):
    d = read("documents").select("doc_id", F.length(F.concat("lang", "source")).alias("l"), "n_chars", F.md5(F.col("text").cast("binary")).alias("h"))
    return D.keeper_rank(d, "h", ["l", "n_chars", (-F.col("doc_id")).alias("i")], "doc_id")


@query("SELECT md5(text) AS h, min(doc_id) AS keeper, array_to_string(list_sort(list(DISTINCT source)), ',') AS pooled FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def tag_pool(read):
    return P.pool_tags(read("documents"), "doc_id", "text", "source")


@query("SELECT l_partkey * 2 AS k, CASE WHEN l_discount > 0.08 THEN 'patch' END AS decision FROM lineitem WHERE l_discount > 0.08 UNION SELECT l_suppkey * 2 + 1, 'patch' FROM lineitem WHERE l_discount > 0.08")
def processed_set(read):
    return L.processed_keys(read("lineitem"), [F.col("l_partkey") * 2, F.col("l_suppkey") * 2 + 1], F.when(F.col("l_discount") > 0.08, "patch"))


@query("SELECT e.event_id, coalesce(c.name, o.name) AS name FROM events e LEFT JOIN (SELECT c_custkey * 2 AS name FROM customer) c ON c.name = e.user_id LEFT JOIN (SELECT old, min(name) AS name FROM (SELECT unnest([c_custkey * 2 + 1, c_custkey * 2 + 3]) AS old, c_custkey * 2 AS name FROM customer) GROUP BY 1) o ON o.old = e.user_id")
def old_name_lookup(read):
    """Customers go by even numbers and were known by two odd ones, which the next customer shares."""
    c = read("customer").select((F.col("c_custkey") * 2).alias("name"), F.array(F.col("c_custkey") * 2 + 1, F.col("c_custkey") * 2 + 3).alias("former"))
    return L.current_name(read("events").select("event_id", "user_id"), "user_id", c, "name", "former").select("event_id", F.col("current").alias("name"))


WORDS = "list_filter(string_split(regexp_replace(lower(text), '\\s+', ' ', 'g'), ' '), lambda x: x <> '')"


@query(
    f"""WITH o AS (SELECT doc_id, coalesce({WORDS}, []) AS a FROM documents),
n AS (SELECT doc_id, list_filter(coalesce({WORDS}, []), lambda x: NOT contains(x, 'th')) AS b FROM documents SEMI JOIN labels USING (doc_id) UNION ALL SELECT item_id + 1000000000, coalesce({WORDS}, []) FROM benchmark),
j AS (SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, a, b FROM o FULL JOIN n ON o.doc_id = n.doc_id)
SELECT doc_id, coalesce(len(a), 0) AS before, coalesce(len(b), 0) AS after, coalesce(len(list_filter(b, lambda x: NOT list_contains(coalesce(a, []), x))), 0) AS added, coalesce(len(list_filter(a, lambda x: NOT list_contains(coalesce(b, []), x))), 0) AS removed, CASE WHEN a IS NULL THEN 'new' WHEN b IS NULL THEN 'gone' WHEN len(b) = 0 THEN 'emptied' ELSE 'changed' END AS status FROM j WHERE a IS DISTINCT FROM b"""
)
def snapshot_diff(read):
    """All documents against a later snapshot: the labelled ones, without some words, and the benchmark's items as new rows."""
    d = read("documents").select("doc_id", T.words(F.col("text")).alias("w"))
    later = d.join(read("labels").select("doc_id"), "doc_id", "left_semi").withColumn("w", F.filter("w", lambda x: ~x.contains("th")))
    later = later.union(read("benchmark").select(F.col("item_id") + 1000000000, T.words(F.col("text"))))
    return diff.snapshot_diff(d, later, "doc_id", "w")


@query("WITH o AS (SELECT user_id, event_type, min(event_id) AS seen FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type, '|' ORDER BY seen) AS merged FROM o GROUP BY 1")
def ordered_union(read):
    """Event types of a user in the order of their first appearance."""
    first = read("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("at"))
    g = first.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("at", "event_type"))).alias("t"))
    return g.select("user_id", F.array_join(F.transform("t", lambda x: x["event_type"]), "|").alias("merged"))


@query("WITH e AS (SELECT user_id, event_type, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events) SELECT event_id, event_type IS NOT DISTINCT FROM prev AS same FROM e")
def same_as_latest(read):
    prev = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("event_id"))
    return read("events").select("event_id", F.col("event_type").eqNullSafe(prev).alias("same"))


@query("SELECT source, bool_and(md5(text) = md5(CASE WHEN doc_id % 50 = 7 THEN text || '.' ELSE text END)) AS unchanged FROM documents GROUP BY 1")
def input_unchanged(read):
    now = F.when(F.col("doc_id") % 50 == 7, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    return read("documents").groupBy("source").agg(F.every(F.md5(F.col("text").cast("binary")) == F.md5(now.cast("binary"))).alias("unchanged"))


@query("WITH a AS (SELECT user_id AS k, max(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1), b AS (SELECT user_id AS k, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY 1 UNION ALL SELECT c_custkey + 1000000000, c_acctbal FROM customer) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN '-' WHEN a.k IS NULL THEN '+' ELSE 'changed' END AS op FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v")
def kv_diff(read):
    """The largest value of each user's clicks against that of the views, and the customers as keys that were added."""
    side = lambda t: read("events").where(F.col("event_type") == t).groupBy(F.col("user_id").alias("k")).agg(F.max("value").alias("v"))
    added = read("customer").select(F.col("c_custkey") + 1000000000, F.col("c_acctbal").cast("double"))
    return L.value_diff(side("click"), side("view").union(added), "k", "v")


@query("SELECT event_id, regexp_replace(props || strftime(ts, '%Y-%m-%d'), '[0-9]{4}-[0-9]{2}-[0-9]{2}', '') = props AS stable FROM events")
def stable_equal(read):
    dated = F.concat("props", F.date_format("ts", "yyyy-MM-dd"))
    return read("events").select("event_id", L.equal_but(dated, F.col("props"), "[0-9]{4}-[0-9]{2}-[0-9]{2}").alias("stable"))


@query("WITH RECURSIVE s AS (SELECT l_orderkey AS a, l_partkey + 10000000 AS b FROM lineitem UNION SELECT l_partkey + 10000000, l_orderkey FROM lineitem), r(node, c) USING KEY (node) AS (SELECT DISTINCT a, a FROM s UNION SELECT s.b, min(r.c) FROM r JOIN s ON s.a = r.node JOIN recurring.r k ON k.node = s.b GROUP BY s.b, k.c HAVING min(r.c) < k.c) SELECT node, c AS component FROM r")
def components(read):
    return connected_components(read("lineitem").select(F.col("l_orderkey").alias("src"), (F.col("l_partkey") + 10000000).alias("dst")))


@query()
def components_all(read):
    """Components over every line item, orders as even and parts as odd nodes."""
    return connected_components(read("lineitem").select((F.col("l_orderkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst")))


def _near(read):
    codes = planted(read).select("vec_id", "label", D.sign_bits(F.col("e")).alias("code"))
    return codes, materialize(D.hamming_pairs(codes, "vec_id", "code", 4), "near")


NEAR = COPIES + ", " + BITS + ", n AS (SELECT x.vec_id AS a, y.vec_id AS b FROM c x JOIN c y ON x.vec_id < y.vec_id AND bit_count(xor(x.b, y.b)) <= 4)"


@query(NEAR.replace("WITH v", "WITH RECURSIVE v") + ", s AS (SELECT a, b FROM n UNION SELECT b, a FROM n), r(node, c) AS (SELECT a, a FROM s UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.node) SELECT node AS vec_id, min(c) AS keeper FROM r GROUP BY 1")
def dedup_report(read):
    """Clusters of near vectors and the keeper of each."""
    return connected_components(_near(read)[1], "a", "b").select(F.col("node").alias("vec_id"), F.col("component").alias("keeper"))


def _pixels(read):
    return planted(read).select("vec_id", "label", F.transform("e", lambda v: v * 127 + 128).alias("p"), D.sign_bits(F.col("e")).alias("code"))


def _judged(px):
    """Every near pair of the rows ``px`` with its evidence and whether it is one item, by the limits of the same-item test."""
    j = D.judged_pairs(D.hamming_pairs(px, "vec_id", "code", 4), px, "vec_id", "p")
    same = (F.col("ssim") >= 0.995) & (F.col("d.mean") <= 2) & (F.col("d.max") <= 24) & (F.col("d.block") <= 8)
    return j.select("a", "b", "distance", "ssim", F.col("d.mean").alias("mean"), F.col("d.max").alias("most"), F.col("d.block").alias("block"), same.alias("same"))


@query()
def same_pairs(read):
    """The whole same-item test on the near pairs of all different vectors, with the number of equal ones on both sides.

    ``same_item`` judges the planted copies alone, ``same_members`` has the classes.
    """
    reps, _ = D.fold_classes(_pixels(read), ["p"], "vec_id", [])
    count = lambda x: reps.select(F.col("vec_id").alias(x), F.col("n").alias("n" + x))
    return _judged(reps).join(count("a"), "a").join(count("b"), "b")


@query(COPIES + "SELECT vec_id, min(vec_id) OVER (PARTITION BY e) AS rep FROM p")
def same_members(read):
    """Every vector and the first of those equal to it."""
    return D.fold_classes(_pixels(read), ["p"], "vec_id", [])[1]


@query()
def dedup_tiers(read):
    """The three tiers: exact and near rows to drop, similar pairs to review; ``dedup_report`` unites by the hash alone."""
    return D.dedup_tiers(_pixels(read), "vec_id", "p", "code", [-F.col("vec_id")])


@query()
def greedy_dedup(read):
    rows = _pixels(read).withColumn("o", -F.col("vec_id"))
    return D.greedy_classes(rows, "label", "vec_id", "o", "p", lambda reps: _judged(reps).where("same").select("a", "b"))


@query()
def content_dedup(read):
    """Vectors by bucket (label) that are first of their kind: a near one in an earlier bucket or with a lesser id counts as its copy."""
    return D.unique_content(_pixels(read), "label", "vec_id", "p", lambda reps: _judged(reps).where("same").select("a", "b"))


@query(SIG.replace("WITH v", "WITH RECURSIVE v") + ", n AS (SELECT x.vec_id AS a, y.vec_id AS b FROM s x JOIN s y ON x.vec_id < y.vec_id AND x.label <> y.label AND list_inner_product(x.e, y.e) >= 0.42), w AS (SELECT a, b FROM n UNION SELECT b, a FROM n), r(node, c) AS (SELECT a, a FROM w UNION SELECT w.b, r.c FROM r JOIN w ON w.a = r.node) SELECT min(c) AS family, node AS vec_id FROM r GROUP BY node")
def families(read):
    """Vectors of different groups that correlate, merged into families."""
    pairs = D.correlated_pairs(planted(read), "vec_id", "e", "label", 0.42)
    return connected_components(spanning(pairs, "a", "b"), "a", "b").select(F.col("component").alias("family"), F.col("node").alias("vec_id"))


@query(COPIES + ", " + BITS + ", r AS (SELECT min(vec_id) AS id, b, ratio, count(*) AS n FROM (SELECT *, (1 + abs(e[1])) * CASE WHEN vec_id >= 1000000 THEN 1 + (vec_id % 3)::DOUBLE * 0.04::DOUBLE ELSE 1 END AS ratio FROM c) GROUP BY b, ratio) SELECT x.id AS a, y.id AS b, x.n AS n_a, y.n AS n_b, bit_count(xor(x.b, y.b))::BIGINT AS distance FROM r x JOIN r y ON x.id < y.id AND bit_count(xor(x.b, y.b)) <= 4 AND abs(x.ratio - y.ratio) <= 0.05::DOUBLE * greatest(x.ratio, y.ratio)")
def aspect_pairs(read):
    """Near hashes of rows whose aspect ratios differ by 5 % at most; copies have ratios that are 0, 4 or 8 % larger."""
    wider = F.when(F.col("vec_id") >= 1000000, 1 + (F.col("vec_id") % 3).cast("double") * 0.04).otherwise(1.0)
    rows = planted(read).select("vec_id", D.sign_bits(F.col("e")).alias("code"), ((1 + F.abs(F.get("e", 0))) * wider).alias("ratio"))
    return D.near_codes(rows, "vec_id", "code", "ratio", 4, 0.05)[0]


def _declared(read):
    """Vectors in groups of up to four of a label, as posts of a source; the planted copies are posts of their own."""
    post = F.expr("vec_id DIV 4")
    key = Y.declared_key(F.col("vec_id"), F.concat(F.lit("src"), F.col("label")), post)
    return _pixels(read).join(planted(read).select("vec_id", "e"), "vec_id").withColumns({"declared": key, "o": -F.col("vec_id")})


def _families(read):
    return Y.family_plan(_declared(read), "vec_id", "declared", "e", "p", "o", lambda reps: _judged(reps).where("same").select("a", "b"), 0.9, 8)


@query()
def family_plans(read):
    """Families of declared groups that correlate, with what stays of each, its bucket and weight."""
    return _families(read)[0]


@query()
def family_members(read):
    """Every vector with its declared group, its family and the vector that it goes for."""
    return _families(read)[1]


@query("WITH t AS (SELECT doc_id // 100 AS batch, doc_id, text FROM documents), n AS (SELECT batch, doc_id, CASE WHEN doc_id % 700 = 7 THEN text || '.' ELSE text END AS text FROM t UNION ALL SELECT * FROM t WHERE doc_id % 1100 = 8), c AS (SELECT batch, doc_id, text, sum(k) AS k FROM (SELECT *, 1 AS k FROM t UNION ALL SELECT *, -1 FROM n) GROUP BY 1, 2, 3) SELECT batch, bool_and(k = 0) AS unchanged FROM c GROUP BY 1")
def input_reuse(read):
    """Whether a batch of documents holds the rows that it held before, each as often: one text in 700 has changed since, one row in 1100 is repeated."""
    then = read("documents").select(F.expr("doc_id DIV 100").alias("batch"), "doc_id", "text")
    changed = F.when(F.col("doc_id") % 700 == 7, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    now = then.withColumn("text", changed).union(then.where("doc_id % 1100 = 8"))
    return reuse.unchanged(now, then, ["batch"])
