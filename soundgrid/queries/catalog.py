"""Queries of sources, registrations, covering and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundgrid.functions import tiles
from soundgrid.operators import covering, gates, intervals, near, quantiles
from soundgrid.queries import query
from soundgrid.queries.views import files, points, registrations, table, with_views
from soundgrid.sinks import tables
from soundgrid.sources import formats, registry

HW = f"CAST({tiles.HALF_WORLD!r} AS DOUBLE)"


@query("SELECT p_partkey, substr(sha256(p_name), 1, 16) AS hash FROM part")
def item_hash(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", registry.item_hash(F.col("p_name")).alias("hash"))


@query("SELECT p_partkey, p_name || '-' || substr(sha256(p_brand), 1, 12) AS address FROM part")
def content_address(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", tables.content_address(F.col("p_name"), F.col("p_brand")).alias("address"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_name END, CASE WHEN c_custkey % 2 = 0 THEN 'recipe' END, 'default') AS property FROM customer")
def source_property(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k, registry.source_property(recipe=F.when(k % 2 == 0, F.lit("recipe")), catalog=F.when(k % 3 == 0, F.col("c_name")), default=F.lit("default")).alias("property"))


@query(with_views('SELECT source, filename, "left", bottom, "right", top, width, height FROM files'))
def scan_files(spark, sf_dir):
    return files(spark, sf_dir).drop("maxzoom")


@query(with_views("SELECT filename, CASE WHEN filename LIKE '/vsi%' THEN filename WHEN width % 2 = 0 THEN 'local/' || filename WHEN source <> 's3' THEN source || '/' || filename ELSE 'local/' || filename END AS path FROM files"))
def resolve_path(spark, sf_dir):
    base = F.when(F.col("source") != "s3", F.col("source"))
    return files(spark, sf_dir).select("filename", registry.resolve_path(F.col("filename"), F.col("width") % 2 == 0, base).alias("path"))


@query("SELECT trim(line) AS entry, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations) t WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#') GROUP BY 1")
def file_list(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select(F.explode(F.split("text", "\n")).alias("value"))
    return registry.file_list(lines).groupBy("entry").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE regexp_full_match(lower(p_name), '(.*1.*|.*7)')")
def glob_filter(spark, sf_dir):
    return registry.glob_filter(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "*1*|*7")


@query("SELECT event_type, user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS k FROM events) t WHERE k = 1")
def dedupe_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return registry.dedupe_latest(events.select("event_type", "user_id", "event_id", "ts", "value"), ["event_type", "user_id"], "ts", "event_id").drop("ts")


@query("SELECT square, name, survey, size, meta FROM (SELECT *, row_number() OVER (PARTITION BY square ORDER BY survey DESC, size DESC, meta, name) AS k2 FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY meta) AS k FROM (SELECT o_custkey % 97 AS square, 'n' || CAST(o_orderkey % 1009 AS VARCHAR) AS name, date_trunc('day', o_orderdate) AS survey, o_totalprice AS size, o_orderkey AS meta FROM orders) a WHERE name NOT IN (SELECT 'n' || CAST(s_suppkey AS VARCHAR) FROM supplier)) b WHERE k = 1) c WHERE k2 = 1")
def select_newest_survey(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 97).alias("square"), F.concat(F.lit("n"), (F.col("o_orderkey") % 1009).cast("string")).alias("name"), F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("survey"), F.col("o_totalprice").alias("size"), F.col("o_orderkey").alias("meta"))
    refused = table(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), F.col("s_suppkey").cast("string")).alias("name"))
    return registry.newest_survey(items, refused).select("square", "name", "survey", "size", "meta")


@query("SELECT c_nationkey AS nation, max(CASE WHEN c_acctbal > 0 THEN c_custkey % 30 END) AS newest FROM customer GROUP BY 1")
def resolve_newest_served(spark, sf_dir):
    """The newest year whose probe succeeds."""
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.max(F.when(F.col("c_acctbal") > 0, F.col("c_custkey") % 30)).alias("newest"))


@query("SELECT n_nationkey AS k, i * 2.5::DOUBLE - w AS west, j * 2.5::DOUBLE - 5 AS south, least((i + 1) * 2.5::DOUBLE - w, 6::DOUBLE) AS east, least((j + 1) * 2.5::DOUBLE - 5, h) AS north FROM (SELECT n_nationkey, 10 + n_nationkey % 7 AS w, CAST(n_nationkey % 5 + 1 AS DOUBLE) AS h FROM nation) n, range(10) a(i), range(5) b(j) WHERE i * 2.5::DOUBLE - w < 6 AND j * 2.5::DOUBLE - 5 < h")
def bbox_cells(spark, sf_dir):
    k = F.col("n_nationkey")
    boxes = table(spark, sf_dir, "nation").select(k.alias("k"), (-(k % 7 + 10.0)).alias("west"), F.lit(-5.0).alias("south"), F.lit(6.0).alias("east"), (k % 5 + 1.0).alias("north"))
    return registry.bbox_cells(boxes, 2.5)


SPEC = "CASE k % 9 WHEN 0 THEN 'zip:*.tif!' || CAST(k AS VARCHAR) WHEN 1 THEN 'tar.gz' WHEN 2 THEN '7z:*' WHEN 3 THEN 'e00!3' WHEN 4 THEN 'netcdf:a' WHEN 5 THEN 'asc-tile' WHEN 6 THEN 'asc-tile:*.asc!2' WHEN 7 THEN 'zip:*!x' ELSE 'gldb' END"


@query(f"SELECT k, split_part(s, ':', 1) AS format, CASE k % 9 WHEN 0 THEN '*.tif' WHEN 2 THEN '*' WHEN 4 THEN 'a' WHEN 6 THEN '*.asc' WHEN 7 THEN '*' END AS members, CAST(CASE k % 9 WHEN 0 THEN k WHEN 6 THEN 2 END AS INT) AS expect, CASE k % 9 WHEN 1 THEN 'tar.gz needs a pattern' WHEN 3 THEN 'unknown format e00!3' WHEN 4 THEN 'netcdf takes no pattern or count' WHEN 7 THEN 'count is no number' END AS problem FROM (SELECT k, {SPEC} AS s FROM (SELECT s_suppkey AS k FROM supplier) q) t")
def parse_unpack(spark, sf_dir):
    k = F.col("s_suppkey")
    spec = F.when(k % 9 == 0, F.concat(F.lit("zip:*.tif!"), k.cast("string")))
    for n, text in enumerate(("tar.gz", "7z:*", "e00!3", "netcdf:a", "asc-tile", "asc-tile:*.asc!2", "zip:*!x"), 1):
        spec = spec.when(k % 9 == n, text)
    return table(spark, sf_dir, "supplier").select(k.alias("k"), *registry.parse_unpack(spec.otherwise("gldb")))


@query("SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'zip' WHEN 1 THEN 'gzip' WHEN 2 THEN 'tif' WHEN 3 THEN '7z' WHEN 4 THEN 'tar' WHEN 5 THEN 'e00' ELSE 'other' END AS kind FROM part")
def kind_sniff(spark, sf_dir):
    k = F.col("p_partkey") % 7
    head = F.when(k == 0, "504B030414").when(k == 1, "1F8B08").when(k == 2, "49492A0008").when(k == 3, "377ABCAF271C00").when(k == 5, "455850202030").otherwise("00")
    head = F.when(k == 4, F.concat(F.repeat(F.hex(F.lit("f")), 257), F.lit("7573746172003030"))).otherwise(head)
    return table(spark, sf_dir, "part").select("p_partkey", registry.kind_sniff(F.unhex(head)).alias("kind"))


@query("SELECT page_id, substr(regexp_replace(regexp_replace(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '\\.[^.]*$', ''), '[^A-Za-z0-9._-]+', '_', 'g'), 1, 100) || '_' || substr(sha256(url), 1, 16) || '.tif' AS name FROM pages")
def staged_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", registry.staged_name(F.col("url"), F.lit("tif")).alias("name"))


@query("SELECT p_brand, count(*) AS claims FROM part GROUP BY 1 HAVING count(*) > 1")
def claim_names(spark, sf_dir):
    return registry.name_collisions(table(spark, sf_dir, "part"), "p_brand")


@query("SELECT p_brand AS path, min(p_size) AS crc, min(p_size) <> max(p_size) AS conflict FROM part GROUP BY 1")
def dedupe_entries(spark, sf_dir):
    return registry.dedupe_entries(table(spark, sf_dir, "part").select(F.col("p_brand").alias("path"), F.col("p_size").alias("crc")))


@query("SELECT p_brand AS archive, count(*) FILTER (p_name LIKE '%1%') AS members, CASE WHEN max(p_size) % 2 = 0 AND count(*) FILTER (p_name LIKE '%1%') <> 3 THEN 'count' WHEN count(*) FILTER (p_name LIKE '%1%') = 0 THEN 'no member' END AS problem FROM part GROUP BY 1")
def members_select(spark, sf_dir):
    """Each brand as an archive of its names; every other one expects three members."""
    part = table(spark, sf_dir, "part")
    most = part.groupBy("p_brand").agg(F.max("p_size").alias("most"))
    entries = part.join(most, "p_brand").select(F.col("p_brand").alias("archive"), F.col("p_name").alias("member"), F.lit("*1*").alias("glob"), F.when(F.col("most") % 2 == 0, 3).alias("expect"))
    return registry.members_select(entries)


@query("SELECT p_partkey AS grid, CAST(i // 7 AS INT) AS row, CAST(i % 7 AS INT) AS col, CAST(p_partkey % 100 + i AS DOUBLE) / 4 AS value FROM part, range(14) r(i)")
def parse_e00(spark, sf_dir):
    """Two rows of seven values a part, five to a line, so each row fills two lines."""
    lines = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("grid"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("line"))
    cell = lambda k: F.floor(F.col("line") / 2) * 7 + F.col("line") % 2 * 5 + k
    text = F.concat(*(F.format_string("%14.6f", (F.col("grid") % 100 + cell(k)) / 4.0) for k in range(5)))
    return formats.fixed_width_values(lines.select("grid", "line", text.alias("value")), row_length=7, keys=["grid"])


@query("SELECT s_nationkey AS file, s_suppkey AS line, CASE WHEN s_suppkey % 5 = 3 THEN 'Second' ELSE 'Lake' || CAST(s_suppkey AS VARCHAR) END AS name, CASE WHEN s_suppkey % 11 <> 7 THEN s_suppkey / CAST(4 AS DOUBLE) END AS lat, CASE WHEN s_suppkey % 11 <> 7 THEN CAST(s_suppkey AS DOUBLE) END AS lon, CASE WHEN s_suppkey % 11 <> 7 AND s_suppkey % 5 <> 3 THEN s_suppkey + CAST(0.5 AS DOUBLE) END AS mean, CASE WHEN s_suppkey % 11 <> 7 AND s_suppkey % 5 <> 3 THEN s_suppkey + CAST(2 AS DOUBLE) END AS deepest, CASE WHEN s_suppkey % 11 = 7 THEN 'fields' END AS problem FROM supplier WHERE s_suppkey % 13 <> 5 AND s_suppkey <> 0 AND s_suppkey < coalesce((SELECT min(q.s_suppkey) FROM supplier q WHERE q.s_nationkey = supplier.s_nationkey AND q.s_suppkey % 3 = 1 AND q.s_suppkey % 13 = 5), 1000000000)")
def parse_inventory(spark, sf_dir):
    """Tables of lakes with rows that go on, rules, rows with a field too many, and references at the end."""
    k = F.col("s_suppkey")
    words = lambda *parts: F.concat_ws(" ", *(p if not isinstance(p, str) else F.lit(p) for p in parts))
    name, lat, lon = F.concat(F.lit("Lake"), k.cast("string")), (k / 4.0).cast("string"), k.cast("string")
    whole = words(name, "Land |", lon, "|", lat, lon, "|", (k + 0.5).cast("string"), (k + 2).cast("string"), "[4]")
    line = F.when(k % 13 == 5, F.when(k % 3 == 1, "1. A book").otherwise("-----")).when(k % 11 == 7, F.concat(whole, F.lit(" 99"))).when(k % 5 == 3, words("Second Land |", lat, lon, "| |", "7")).otherwise(whole)
    line = F.when((k % 11 == 7) & (k % 5 == 3) & (k % 13 != 5), F.concat(words("Second Land |", lat, lon, "| |", "7"), F.lit(" 99"))).otherwise(line)
    return formats.inventory(table(spark, sf_dir, "supplier").filter("s_suppkey <> 0").select(F.col("s_nationkey").alias("file"), k.alias("line"), line.alias("value")))


@query("SELECT CAST(c_custkey AS DOUBLE) AS lon, c_custkey / CAST(2 AS DOUBLE) AS lat, CAST(c_custkey % 7 AS DOUBLE) AS value FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey <> 0")
def read_points(spark, sf_dir):
    k = F.col("c_custkey")
    line = F.when(k % 5 == 0, F.lit("# comment")).otherwise(F.concat_ws(" , ", k.cast("string"), (k / 2).cast("string"), (k % 7).cast("string")))
    return formats.points(table(spark, sf_dir, "customer").select(line.alias("value")))


PROBED = "SELECT 'p' || CAST(l_suppkey % 8 AS VARCHAR) AS source, CASE l_suppkey % 8 WHEN 0 THEN l_quantity WHEN 1 THEN -l_quantity WHEN 2 THEN l_quantity - 20 WHEN 3 THEN 20 - l_quantity WHEN 4 THEN l_quantity - 30 WHEN 5 THEN CASE WHEN l_linenumber = 1 THEN 60 ELSE -l_quantity END ELSE l_quantity - l_suppkey % 8 * 5 END AS z FROM lineitem"


@query(with_views("SELECT source, min(z) AS low, max(z) AS high, round(avg(z), 9) AS mean, min(z) >= 0 OR (abs(max(z)) > abs(min(z)) AND max(z) > 0 AND avg(z) > 0) AS negate FROM probed GROUP BY 1", probed=PROBED))
def source_probe(spark, sf_dir):
    """Sources whose values are depths, heights or both."""
    k, q = F.col("l_suppkey") % 8, F.col("l_quantity")
    z = F.when(k == 0, q).when(k == 1, -q).when(k == 2, q - 20).when(k == 3, 20 - q).when(k == 4, q - 30).when(k == 5, F.when(F.col("l_linenumber") == 1, 60).otherwise(-q)).otherwise(q - k * 5)
    stats = registry.probe(table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), k.cast("string")).alias("source"), z.alias("z")))
    return stats.withColumn("mean", F.round("mean", 9))


LISTED = "SELECT 's' || CAST(o_custkey % 9 AS VARCHAR) AS source, 'u' || CAST(CASE WHEN o_custkey % 9 = 4 THEN o_orderkey // 8 ELSE o_orderkey END AS VARCHAR) AS url FROM orders WHERE o_orderstatus <> 'P' AND (o_custkey % 9 < 5 OR o_orderkey % 30 > o_custkey % 9)"


@query(with_views("SELECT n.source, now, coalesce(before, 0) AS before, dups AS duplicates, CASE WHEN dups > 0 THEN 'duplicates' WHEN n.source IN ('s1', 's3', 's5', 's7') AND 1 - now / CAST(before AS DOUBLE) > CAST(0.25 AS DOUBLE) THEN 'shrank' END AS problem FROM (SELECT source, sum(k) AS now, count(*) FILTER (k > 1) AS dups FROM (SELECT source, url, count(*) AS k FROM listed GROUP BY 1, 2) t GROUP BY 1) n LEFT JOIN (SELECT 's' || CAST(o_custkey % 9 AS VARCHAR) AS source, count(*) AS before FROM orders WHERE o_custkey % 9 <> 2 GROUP BY 1) b ON b.source = n.source", listed=LISTED))
def write_items(spark, sf_dir):
    """What keeps a source's items from being written: repeated addresses, and a listing that shrank by over a quarter."""
    k, o = F.col("o_custkey") % 9, F.col("o_orderkey")
    source = F.concat(F.lit("s"), k.cast("string")).alias("source")
    orders = table(spark, sf_dir, "orders")
    url = F.concat(F.lit("u"), F.when(k == 4, F.floor(o / 8)).otherwise(o).cast("string"))
    now = orders.filter((F.col("o_orderstatus") != "P") & ((k < 5) | (o % 30 > k))).select(source, url.alias("url"), (k % 2 == 1).alias("listed"))
    return registry.listing_guard(now, orders.filter(k != 2).select(source, o.cast("string").alias("url")), 0.25)


@query("SELECT CAST(p_size AS REAL) AS z FROM part UNION ALL SELECT CAST(p_retailprice AS REAL) FROM part")
def float32_promote(spark, sf_dir):
    """Values of different types under one type of four bytes."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_size").cast("float").alias("z")).unionByName(part.select(F.col("p_retailprice").cast("float").alias("z")))


# Registration.


@query(with_views("SELECT n.filename, coalesce(n.value, b.value) AS value, n.value IS NULL AND b.value IS NOT NULL AS carried FROM regs_now n LEFT JOIN regs_before b ON n.filename = b.filename"))
def carry_forward(spark, sf_dir):
    return registry.carry_forward(registrations(spark, sf_dir, "O"), registrations(spark, sf_dir, "F"), "filename", "value")


@query(with_views("SELECT filename FROM regs_before EXCEPT SELECT filename FROM regs_now"))
def removed_keys(spark, sf_dir):
    return registry.removed_keys(registrations(spark, sf_dir, "F"), registrations(spark, sf_dir, "O"), "filename")


@query(with_views("SELECT filename FROM regs_before INTERSECT SELECT filename FROM regs_now"))
def shared_cells(spark, sf_dir):
    return registrations(spark, sf_dir, "F").select("filename").intersect(registrations(spark, sf_dir, "O").select("filename"))


@query(with_views("SELECT filename FROM regs_now EXCEPT SELECT filename FROM regs_before"))
def absent_layers(spark, sf_dir):
    return registrations(spark, sf_dir, "O").select("filename").exceptAll(registrations(spark, sf_dir, "F").select("filename"))


@query(with_views("SELECT count(*) FILTER (a.filename IS NOT NULL AND b.filename IS NOT NULL) AS \"both\", count(*) FILTER (b.filename IS NULL) AS a_only, count(*) FILTER (a.filename IS NULL) AS b_only FROM regs_before a FULL JOIN regs_now b ON a.filename = b.filename"))
def ab_present(spark, sf_dir):
    return gates.presence(registrations(spark, sf_dir, "F"), registrations(spark, sf_dir, "O"), ["filename"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def completeness(spark, sf_dir):
    return gates.completeness(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT DISTINCT s_nationkey AS nation FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer)")
def orphan_source(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")).distinct().join(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")), "nation", "left_semi")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)", name="gc_collect")
def gc_collect(spark, sf_dir):
    return tables.unreferenced(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").filter("not refused").drop("refused")


@query("SELECT filename, value, 'before' AS layer, CAST(NULL AS BOOLEAN) AS carried FROM (" + with_views("SELECT * FROM regs_before") + ") a UNION ALL SELECT filename, value, NULL, true FROM (" + with_views("SELECT * FROM regs_now") + ") b")
def union_layers(spark, sf_dir):
    a = registrations(spark, sf_dir, "F").withColumn("layer", F.lit("before"))
    return a.unionByName(registrations(spark, sf_dir, "O").withColumn("carried", F.lit(True)), allowMissingColumns=True)


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(with_views("SELECT filename, count(*) AS n FROM (SELECT filename FROM regs_before UNION ALL SELECT filename FROM regs_now) t GROUP BY 1 HAVING count(*) > 1"))
def disjoint_merge(spark, sf_dir):
    """What stands in the way of a merge of two archives."""
    both = registrations(spark, sf_dir, "F").select("filename").unionByName(registrations(spark, sf_dir, "O").select("filename"))
    return both.groupBy("filename").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


# Covering.


SIDE8 = f"CAST({2 * tiles.HALF_WORLD / 256!r} AS DOUBLE)"
SPLIT = f'SELECT source, filename, maxzoom, bottom, top, "left", CASE WHEN "left" > "right" THEN {HW} ELSE "right" END AS "right" FROM files UNION ALL SELECT source, filename, maxzoom, bottom, top, -{HW}, "right" FROM files WHERE "left" > "right"'
MACRO = f'SELECT x, y FROM (SELECT CAST(i AS INT) AS x FROM range(256) a(i)) a, (SELECT CAST(i AS INT) AS y FROM range(256) b(i)) b WHERE (x * 31 + y * 17) % 5 < 3'


def _macro(spark):
    ids = spark.range(256 * 256).select(F.floor(F.col("id") / 256).cast("int").alias("x"), (F.col("id") % 256).cast("int").alias("y"))
    return ids.filter((F.col("x") * 31 + F.col("y") * 17) % 5 < 3)


OVERLAP = f'SELECT DISTINCT filename, source, maxzoom, x, y FROM parts p JOIN macro m ON p."left" < x * {SIDE8} - {HW} + {SIDE8} AND p."right" > x * {SIDE8} - {HW} AND p.bottom < {HW} - y * {SIDE8} AND p.top > {HW} - y * {SIDE8} - {SIDE8}'


@query(with_views(f"SELECT filename, x, y FROM ({OVERLAP}) t", parts=SPLIT, macro=MACRO))
def bbox_overlap_join(spark, sf_dir):
    return covering.bbox_overlap_join(files(spark, sf_dir), _macro(spark))


@query(with_views("SELECT source, max(greatest(least(maxzoom, 15), 8)) AS maxzoom FROM files GROUP BY 1"))
def source_maxzooms(spark, sf_dir):
    return registry.source_maxzooms(files(spark, sf_dir).withColumn("maxzoom", tiles.resolved_maxzoom(F.col("maxzoom"), F.lit(None).cast("int"))))


def _items(spark, sf_dir):
    f = files(spark, sf_dir)
    return covering.bbox_overlap_join(f, _macro(spark)).join(f.select("filename", "source", "maxzoom"), "filename")


GROUPS = "SELECT x, y, string_agg(DISTINCT source || ':' || CAST(maxzoom AS VARCHAR), ',' ORDER BY source || ':' || CAST(maxzoom AS VARCHAR)) AS group_id, max(maxzoom) AS maxzoom FROM items GROUP BY 1, 2"


@query(with_views(GROUPS, parts=SPLIT, macro=MACRO, items=OVERLAP))
def group_id(spark, sf_dir):
    return covering.group_ids(_items(spark, sf_dir))


@query(with_views("SELECT x, y, count(DISTINCT filename) AS files, max(maxzoom) AS child_z FROM items GROUP BY 1, 2", parts=SPLIT, macro=MACRO, items=OVERLAP))
def aggregation_items(spark, sf_dir):
    return _items(spark, sf_dir).groupBy("x", "y").agg(F.count_distinct("filename").alias("files"), F.max("maxzoom").alias("child_z"))


def _tree() -> str:
    """The descent in SQL: each zoom's tiles that stop, then the macrotiles that are left."""
    ctes, left = [], "groups"
    for z in range(4, 9):
        up = 8 - z
        stop = "true" if z == 8 else f"min(group_id) = max(group_id) AND {z} >= max(maxzoom) - 4"
        ctes.append((f"stop{z}", f"SELECT x >> {up} AS tx, y >> {up} AS ty FROM {left} GROUP BY 1, 2 HAVING {stop}"))
        ctes.append((f"left{z}", f"SELECT l.* FROM {left} l LEFT JOIN stop{z} s ON l.x >> {up} = s.tx AND l.y >> {up} = s.ty WHERE s.tx IS NULL"))
        left = f"left{z}"
    return with_views(" UNION ALL ".join(f"SELECT {z} AS z, tx AS x, ty AS y FROM stop{z}" for z in range(4, 9)), parts=SPLIT, macro=MACRO, items=OVERLAP, groups=GROUPS, **dict(ctes))


@query(_tree())
def aggregation_tiles(spark, sf_dir):
    return covering.aggregation_tiles(covering.group_ids(_items(spark, sf_dir)))


STEMS = "SELECT CAST(z AS VARCHAR) || '-' || CAST(x AS VARCHAR) || '-' || CAST(y AS VARCHAR) || '-' || CAST(cz AS VARCHAR) AS stem, z, x, y, cz AS child_z FROM (SELECT DISTINCT CAST(4 + o_orderkey % 4 AS INT) AS z, CAST(o_custkey % (16 << CAST(o_orderkey % 4 AS INT)) AS INT) >> 2 AS x, CAST(o_orderkey // 4 % (16 << CAST(o_orderkey % 4 AS INT)) AS INT) >> 2 AS y, CAST(9 + o_custkey % 3 AS INT) AS cz FROM orders) t"


def _stems(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    z = (F.col("o_orderkey") % 4).cast("int")
    side = F.call_function("shiftleft", F.lit(16), z)
    rows = o.select((z + 4).alias("z"), F.shiftright((F.col("o_custkey") % side).cast("int"), 2).alias("x"), F.shiftright((F.floor(F.col("o_orderkey") / 4) % side).cast("int"), 2).alias("y"), (F.col("o_custkey") % 3 + 9).cast("int").alias("child_z")).distinct()
    return rows.withColumn("stem", tiles.stem(F.col("z"), F.col("x"), F.col("y"), F.col("child_z")))


@query(with_views("SELECT DISTINCT a.stem AS coarse, b.stem AS fine FROM stems a JOIN stems b ON b.child_z = a.child_z + 1 AND (a.z <= b.z AND b.x >> (b.z - a.z) = a.x AND b.y >> (b.z - a.z) = a.y OR b.z < a.z AND a.x >> (a.z - b.z) = b.x AND a.y >> (a.z - b.z) = b.y)", stems=STEMS))
def finer_index(spark, sf_dir):
    return covering.finer_index(_stems(spark, sf_dir))


@query(with_views("SELECT stem, z, x, y, child_z FROM stems", stems=STEMS))
def parse_stem(spark, sf_dir):
    return _stems(spark, sf_dir).select("stem", *tiles.parse_stem(F.col("stem")))


@query(with_views("SELECT a.stem, b.stem AS other FROM stems a JOIN stems b ON a.z = b.z AND a.child_z = b.child_z AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1", stems=STEMS))
def tile_neighbourhood(spark, sf_dir):
    s = _stems(spark, sf_dir)
    around = F.explode(F.array(*(F.struct((F.col("x") + i).alias("nx"), (F.col("y") + j).alias("ny")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    sent = s.select("stem", "z", "child_z", around.alias("n")).select("stem", "z", "child_z", F.col("n.nx").alias("x"), F.col("n.ny").alias("y"))
    return sent.join(s.select(F.col("stem").alias("other"), "z", "child_z", "x", "y"), ["z", "child_z", "x", "y"]).select("stem", "other")


@query(with_views("SELECT z, x, y, found_z, stem FROM (SELECT r.z, r.x, r.y, s.z AS found_z, s.stem, row_number() OVER (PARTITION BY r.z, r.x, r.y ORDER BY s.z DESC NULLS LAST, s.stem DESC) AS k FROM (SELECT 9 AS z, CAST(c_custkey % 512 AS INT) AS x, CAST(c_custkey * 7 % 512 AS INT) AS y FROM customer GROUP BY 1, 2, 3) r LEFT JOIN stems s ON r.x >> (9 - s.z) = s.x AND r.y >> (9 - s.z) = s.y) t WHERE k = 1", stems=STEMS))
def ancestor_lookup(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select(F.lit(9).alias("z"), (F.col("c_custkey") % 512).cast("int").alias("x"), (F.col("c_custkey") * 7 % 512).cast("int").alias("y")).distinct()
    return covering.deepest_ancestor(asked, _stems(spark, sf_dir), ["stem"])


@query(with_views("SELECT stem, x >> (z - 4) AS cell_x, y >> (z - 4) AS cell_y FROM stems", stems=STEMS))
def cell_route(spark, sf_dir):
    up = F.col("z") - 4
    return _stems(spark, sf_dir).select("stem", F.call_function("shiftright", F.col("x"), up).alias("cell_x"), F.call_function("shiftright", F.col("y"), up).alias("cell_y"))


@query(with_views("SELECT s.stem FROM stems s WHERE (s.x >> (s.z - 4)) % 3 = 0", stems=STEMS))
def owned_subtree(spark, sf_dir):
    cells = spark.range(16).filter("id % 3 = 0").select(F.col("id").cast("int").alias("cell_x"))
    keyed = _stems(spark, sf_dir).withColumn("cell_x", F.call_function("shiftright", F.col("x"), F.col("z") - 4))
    return keyed.join(cells, "cell_x", "left_semi").select("stem")


def _resolutions() -> str:
    return ", ".join(f"({z}, CAST({tiles.resolution(z)!r} AS DOUBLE))" for z in range(33))


@query(with_views(f"SELECT filename, min(z) AS zoom FROM (SELECT filename, least((top - bottom) / width, (top - bottom) / height) AS size FROM files) f JOIN (VALUES {_resolutions()}) t(z, res) ON res <= size GROUP BY 1"))
def native_overzoom(spark, sf_dir):
    span = F.col("top") - F.col("bottom")
    return files(spark, sf_dir).select("filename", tiles.native_overzoom(span / F.col("width"), span / F.col("height")).alias("zoom"))


@query(with_views("SELECT filename, greatest(least(maxzoom, CASE WHEN width % 2 = 0 THEN 10 ELSE 15 END, 15), 8) AS zoom FROM files"))
def resolved_maxzoom(spark, sf_dir):
    return files(spark, sf_dir).select("filename", tiles.resolved_maxzoom(F.col("maxzoom"), F.when(F.col("width") % 2 == 0, 10)).alias("zoom"))


@query(with_views("SELECT stem, least(greatest(CAST(ceil((pow(CAST(2 AS DOUBLE), child_z - z) * 512 + 128) * (pow(CAST(2 AS DOUBLE), child_z - z) * 512 + 128) * 4 / CAST(1e9 AS DOUBLE) * 3) AS INT), 1), 20) AS gb FROM stems", stems=STEMS))
def job_weight(spark, sf_dir):
    return _stems(spark, sf_dir).select("stem", tiles.job_weight(F.col("z"), F.col("child_z"), 3.0, 20).alias("gb"))


@query(with_views('SELECT filename, CASE WHEN w THEN "right" ELSE "left" END AS "left", CASE WHEN w THEN "left" ELSE "right" END AS "right" FROM (SELECT filename, "left", "right" + CASE WHEN width % 10 = 0 THEN CAST(4e7 AS DOUBLE) ELSE 0 END AS "right", "right" + CASE WHEN width % 10 = 0 THEN CAST(4e7 AS DOUBLE) ELSE 0 END - "left" > ' + f"CAST({0.9 * 2 * tiles.HALF_WORLD!r} AS DOUBLE) AS w FROM files) t"))
def scan_local_files(spark, sf_dir):
    right = F.col("right") + F.when(F.col("width") % 10 == 0, 4e7).otherwise(0.0)
    left, right = tiles.wrap_antimeridian(F.col("left"), right)
    return files(spark, sf_dir).select("filename", left.alias("left"), right.alias("right"))


@query(with_views(f"""SELECT source, round(CASE WHEN wraps = 0 THEN w WHEN e360 - w360 >= 360 THEN -180 ELSE fmod(w360 + 180, 360) - 180 END, 6) AS west, round(degrees(2 * atan(exp(b / {HW} * pi())) - pi() / 2), 6) AS south, round(CASE WHEN wraps = 0 THEN e WHEN e360 - w360 >= 360 THEN 180 ELSE fmod(e360 + 180, 360) - 180 END, 6) AS east, round(degrees(2 * atan(exp(t / {HW} * pi())) - pi() / 2), 6) AS north, files FROM (
    SELECT source, min(w) AS w, max(e) AS e, min(bottom) AS b, max(top) AS t, max(CASE WHEN w > e THEN 1 ELSE 0 END) AS wraps, min(fmod(w + 360, 360)) AS w360, max(fmod(w + 360, 360) + fmod(e - w + 720, 360)) AS e360, count(*) AS files FROM (SELECT source, "left" / {HW} * 180 AS w, "right" / {HW} * 180 AS e, bottom, top FROM files) f GROUP BY source) g"""))
def bbox_union(spark, sf_dir):
    return covering.bbox_union(files(spark, sf_dir))


# Intervals and neighbours.


def _spans(spark, sf_dir, flag):
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == flag)
    return rows.select((F.col("l_suppkey") % 50).alias("edge"), (F.col("l_partkey") % 1000).cast("int").alias("lo"), (F.col("l_partkey") % 1000 + F.col("l_linenumber")).cast("int").alias("hi"))


def _span_sql(flag: str) -> str:
    return f"SELECT l_suppkey % 50 AS edge, CAST(l_partkey % 1000 AS INT) AS lo, CAST(l_partkey % 1000 + l_linenumber AS INT) AS hi FROM lineitem WHERE l_returnflag = '{flag}'"


ISLANDS = "SELECT edge, CAST(min(p) AS INT) AS lo, CAST(max(p) + 1 AS INT) AS hi FROM (SELECT edge, p, p - row_number() OVER (PARTITION BY edge ORDER BY p) AS g FROM ({cells}) q) t GROUP BY edge, g"
CELLS_OF = "SELECT DISTINCT edge, unnest(range(lo, hi)) AS p FROM {v}"


@query(with_views(ISLANDS.format(cells=CELLS_OF.format(v="spans_a")), spans_a=_span_sql("A")))
def interval_union(spark, sf_dir):
    return intervals.interval_union(_spans(spark, sf_dir, "A"), ["edge"])


@query(with_views(ISLANDS.format(cells=f"{CELLS_OF.format(v='spans_a')} INTERSECT {CELLS_OF.format(v='spans_r')}"), spans_a=_span_sql("A"), spans_r=_span_sql("R")))
def interval_intersect(spark, sf_dir):
    return intervals.interval_intersect(_spans(spark, sf_dir, "A"), _spans(spark, sf_dir, "R"), ["edge"])


@query(with_views(ISLANDS.format(cells=f"({CELLS_OF.format(v='spans_a')} EXCEPT {CELLS_OF.format(v='spans_r')}) UNION ({CELLS_OF.format(v='spans_r')} EXCEPT {CELLS_OF.format(v='spans_a')})"), spans_a=_span_sql("A"), spans_r=_span_sql("R")))
def sym_diff(spark, sf_dir):
    return intervals.interval_difference(_spans(spark, sf_dir, "A"), _spans(spark, sf_dir, "R"), ["edge"])


@query(with_views("SELECT id, near_id, round(d, 9) AS distance FROM (SELECT a.id, b.id AS near_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d, row_number() OVER (PARTITION BY a.id ORDER BY sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), b.id) AS k FROM points a JOIN points b ON a.id <> b.id AND b.x BETWEEN a.x - 8 AND a.x + 8 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 8) t WHERE k = 1"))
def nearest_neighbour(spark, sf_dir):
    p = points(spark, sf_dir)
    return near.nearest_neighbour(p, p, 8.0).select("id", "near_id", F.round("distance", 9).alias("distance"))


# Roll-ups, limits and samples.


@query("SELECT event_type, count(*) AS n, round(sum(value), 6) AS total, round(avg(value), 9) AS mean, max(value) AS most FROM events GROUP BY 1 ORDER BY total DESC")
def build_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"), F.round(F.avg("value"), 9).alias("mean"), F.max("value").alias("most"))
    return e.orderBy(F.desc("total"))


RUNS = "SELECT * FROM (SELECT CASE user_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS label, event_type AS stage, user_id // 3 AS stem, value AS wall, CAST(event_id % 50 AS DOUBLE) AS parts, row_number() OVER (PARTITION BY user_id % 3, event_type, user_id // 3 ORDER BY event_id DESC) AS k FROM events) t WHERE k = 1 AND label <> 'c'"
TOLD = "SELECT a.stage, a.stem, m.metric, CASE m.metric WHEN 'wall' THEN a.wall ELSE a.parts END AS was, CASE m.metric WHEN 'wall' THEN b.wall ELSE b.parts END AS now, CASE m.metric WHEN 'wall' THEN CAST(0.10 AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) END AS bound FROM (SELECT * FROM runs WHERE label = 'a') a JOIN (SELECT * FROM runs WHERE label = 'b') b ON b.stage = a.stage AND b.stem = a.stem, (VALUES ('wall'), ('parts')) m(metric)"


@query(with_views("SELECT stage, stem, metric, was, now, round((now - was) / was, 9) AS change, CASE WHEN (now - was) / was > bound THEN 'regressed' END AS verdict FROM told WHERE was <> 0 AND now IS NOT NULL UNION ALL SELECT coalesce(a.stage, b.stage), coalesce(a.stem, b.stem), NULL, NULL, NULL, NULL, CASE WHEN a.stem IS NULL THEN 'missing a' ELSE 'missing b' END FROM (SELECT * FROM runs WHERE label = 'a') a FULL JOIN (SELECT * FROM runs WHERE label = 'b') b ON b.stage = a.stage AND b.stem = a.stem WHERE a.stem IS NULL OR b.stem IS NULL", runs=RUNS, told=TOLD))
def bench_compare(spark, sf_dir):
    """Two runs by stage and stem: the last of each counts, against limits; what one lacks is told."""
    u = F.col("user_id")
    rows = table(spark, sf_dir, "events").select(F.when(u % 3 == 0, "a").when(u % 3 == 1, "b").otherwise("c").alias("label"), F.col("event_type").alias("stage"), F.floor(u / 3).alias("stem"), "event_id", F.col("value").alias("wall"), (F.col("event_id") % 50).cast("double").alias("parts"))
    return gates.compare_runs(rows, "a", "b", "event_id", {"wall": 0.10, "parts": 0.01}).withColumn("change", F.round("change", 9))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def worst_k(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("SELECT o_orderstatus, o_orderkey FROM (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders) t WHERE k % 10 = 1")
def stride_sample(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("o_orderstatus").orderBy("o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("k", F.row_number().over(w)).filter("k % 10 = 1").select("o_orderstatus", "o_orderkey")


@query("SELECT o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) < '8' OR o_orderstatus = 'P' AND substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) < 'c'")
def stratified_sample(spark, sf_dir):
    """Half of two strata and three quarters of the third, by a hash of the key."""
    digit = F.substring(F.md5(F.col("o_orderkey").cast("string").cast("binary")), 1, 1)
    return table(spark, sf_dir, "orders").filter(digit < F.when(F.col("o_orderstatus") == "P", "c").otherwise("8")).select("o_orderstatus", "o_orderkey")


@query("SELECT l_returnflag, round(avg(d), 9) AS mean, max(d) AS most, round(quantile_cont(d, 0.5), 9) AS median, round(quantile_cont(d, 0.95), 9) AS p95, count(*) FILTER (d > 1) / CAST(count(*) AS DOUBLE) AS over_one FROM (SELECT l_returnflag, l_extendedprice / CAST(1000 AS DOUBLE) AS d FROM lineitem) t GROUP BY 1")
def tile_stats(spark, sf_dir):
    d = F.col("l_extendedprice") / 1000.0
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", d.alias("d"))
    stats = rows.groupBy("l_returnflag").agg(F.round(F.avg("d"), 9).alias("mean"), F.max("d").alias("most"), (F.count(F.when(F.col("d") > 1, 1)) / F.count(F.lit(1))).alias("over_one"))
    found = quantiles.exact_quantiles(rows, ["l_returnflag"], "d", {"median": 0.5, "p95": 0.95})
    return stats.join(found.withColumns({c: F.round(c, 9) for c in ("median", "p95")}), "l_returnflag")


@query("SELECT n.n_regionkey AS region, sum(s.score) FILTER (true) AS score FROM (SELECT s_nationkey, CASE WHEN count(*) FILTER (s_acctbal < 0) > 0 THEN NULL ELSE count(*) END AS score FROM supplier GROUP BY 1) s JOIN nation n ON n.n_nationkey = s.s_nationkey GROUP BY 1 HAVING count(*) = count(s.score)")
def dome_report(spark, sf_dir):
    """Sums of scores, only where all are scored."""
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.when(F.count(F.when(F.col("s_acctbal") < 0, 1)) == 0, F.count(F.lit(1))).alias("score"))
    n = s.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("region"))
    return n.agg(F.sum("score").alias("score"), (F.count("score") == F.count(F.lit(1))).alias("whole")).filter("whole").drop("whole")


@query("SELECT l_returnflag AS layer, min(l_linenumber) AS minzoom, max(l_linenumber) AS maxzoom, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS fields FROM lineitem GROUP BY 1")
def layer_union(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("layer")).agg(F.min("l_linenumber").alias("minzoom"), F.max("l_linenumber").alias("maxzoom"), F.array_join(F.sort_array(F.collect_set("l_linestatus")), ",").alias("fields"))


@query("SELECT count(*) AS merged, (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey % 16) t) AS shards FROM lineitem")
def tile_census(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 16).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("shards")).crossJoin(table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("merged"))).select("merged", "shards")


@query("SELECT s_suppkey, TRY_CAST(CASE WHEN s_suppkey % 3 = 0 THEN 'bad' ELSE CAST(s_suppkey AS VARCHAR) END AS DOUBLE) AS drval1 FROM supplier")
def heal_schema(spark, sf_dir):
    text = F.when(F.col("s_suppkey") % 3 == 0, "bad").otherwise(F.col("s_suppkey").cast("string"))
    return gates.heal_schema(table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("drval1")), ["drval1"])
