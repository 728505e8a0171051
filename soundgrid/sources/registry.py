"""Listings and registrations as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The file row's columns.
FILE_COLUMNS = "source string, filename string, left double, bottom double, right double, top double, width int, height int"


def scan_sources(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row a source's recipe (a JSON document in its own folder); the folder's name is the source."""
    docs = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return docs.withColumn("source", F.element_at(F.split(F.input_file_name(), "/"), -2))


def source_property(recipe: Column, catalog: Column, default: Column) -> Column:
    """What the catalog says, or the recipe, or the default."""
    return F.coalesce(catalog, recipe, default)


def file_list(lines: DataFrame) -> DataFrame:
    """The entries of a list file: trimmed lines without comments and blanks."""
    return lines.select(F.trim("value").alias("entry")).filter((F.col("entry") != "") & ~F.startswith("entry", F.lit("#")))


def item_hash(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)


def glob_pattern(globs: str) -> str:
    """Shell patterns, parted by bars, as one regular expression over a whole lowered path."""

    def one(glob: str) -> str:
        return "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob.lower())

    return "^(?:" + "|".join(map(one, globs.split("|"))) + ")$"


def glob_filter(listing: DataFrame, column: str, globs: str) -> DataFrame:
    return listing.filter(F.lower(column).rlike(glob_pattern(globs)))


def resolve_path(path: Column, local: Column, base: Column) -> Column:
    """A virtual path as it is; a local file if there is one; else under the base address, if there is one."""
    return F.when(F.startswith(path, F.lit("/vsi")), path).when(local, F.concat(F.lit("local/"), path)).when(base.isNotNull(), F.concat(base, F.lit("/"), path)).otherwise(F.concat(F.lit("local/"), path))


def dedupe_latest(listing: DataFrame, cell: list[str], modified: str, tie: str) -> DataFrame:
    """The newest row of each cell; of equally new ones the first by ``tie``. One aggregation, no sort."""
    rest = [c for c in listing.columns if c not in cell]
    order = F.struct((-F.unix_micros(F.col(modified))).alias("_m"), F.col(tie).alias("_t"))
    best = listing.groupBy(*cell).agg(F.min_by(F.struct(*rest), order).alias("b"))
    return best.select(*cell, *(F.col(f"b.{c}").alias(c) for c in rest))


def newest_survey(items: DataFrame, refused: DataFrame) -> DataFrame:
    """Two choices after leaving out refused names: each name's lowest meta id, then each square's newest survey, size and lowest id."""
    left = items.join(refused, "name", "left_anti")
    named = Window.partitionBy("name").orderBy("meta")
    square = Window.partitionBy("square").orderBy(F.desc("survey"), F.desc("size"), "meta", "name")
    once = left.withColumn("_n", F.row_number().over(named)).filter("_n = 1").drop("_n")
    return once.withColumn("_s", F.row_number().over(square)).filter("_s = 1").drop("_s")


def carry_forward(current: DataFrame, previous: DataFrame, key: str, value: str) -> DataFrame:
    """Each current key's value, or the previous one where it couldn't be read now."""
    before = previous.select(key, F.col(value).alias("_before"))
    joined = current.join(before, key, "left")
    return joined.select(key, F.coalesce(value, "_before").alias(value), (F.col(value).isNull() & F.col("_before").isNotNull()).alias("carried"))


def removed_keys(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    return previous.select(key).distinct().join(current.select(key), key, "left_anti")


#: Formats that need a pattern for their members, that may have one, and that have none. Fixed values.
GLOB_FORMATS, MAYBE_GLOB, PLAIN_FORMATS = ("zip", "tar.gz", "7z"), ("asc-tile",), ("asc-mosaic", "e00", "gldb", "netcdf")


def parse_unpack(spec: Column) -> list[Column]:
    """``format[:glob][!count]`` as ``format, members, expect`` and what is wrong with it (``problem``): archives need a pattern, whole assets take neither pattern nor count."""
    blank = lambda c: F.nullif(c, F.lit(""))
    kind, rest = F.regexp_extract(spec, r"^([^:]*)", 1), F.regexp_extract(spec, r"^[^:]*:(.*)$", 1)
    members, count = blank(F.regexp_extract(rest, r"^([^!]*)", 1)), blank(F.regexp_extract(rest, r"^[^!]*!(.*)$", 1))
    expect = count.try_cast("int")
    problem = (
        F.when(~kind.isin(*GLOB_FORMATS, *MAYBE_GLOB, *PLAIN_FORMATS), F.concat(F.lit("unknown format "), kind))
        .when(F.contains(rest, F.lit("!")) & expect.isNull(), F.lit("count is no number"))
        .when(kind.isin(*GLOB_FORMATS) & members.isNull(), F.concat(kind, F.lit(" needs a pattern")))
        .when(kind.isin(*PLAIN_FORMATS) & (members.isNotNull() | expect.isNotNull()), F.concat(kind, F.lit(" takes no pattern or count")))
    )
    return [kind.alias("format"), members.alias("members"), expect.alias("expect"), problem.alias("problem")]


def members_select(entries: DataFrame) -> DataFrame:
    """Of each archive's ``entries(archive, member, glob, expect)`` the number of members that its pattern takes, and what is wrong: none, or not as many as expected.

    All entries are grouped, so an archive of which nothing matches has a row that says so.
    """
    hit = F.regexp_like(F.lower("member"), glob_column(F.col("glob")))
    counts = entries.groupBy("archive").agg(F.count(F.when(hit, 1)).alias("members"), F.max("expect").alias("expect"))
    problem = F.when(F.col("expect").isNotNull() & (F.col("members") != F.col("expect")), "count").when(F.col("members") == 0, "no member")
    return counts.select("archive", "members", problem.alias("problem"))


def kind_sniff(content: Column) -> Column:
    """A file's kind by its first bytes; a tar archive's are at 257."""
    head = F.hex(F.substring(content, 1, 8))
    out = F.when(F.hex(F.substring(content, 258, 5)) == "7573746172", "tar")
    kinds = (("455850", "e00"), ("434446", "netcdf"), ("89484446", "netcdf"), ("4949", "tif"), ("4D4D", "tif"))
    for magic, kind in kinds:
        out = out.when(F.startswith(head, F.lit(magic)), kind)
    out = out.otherwise("other")
    for magic, kind in (("1F8B", "gzip"), ("377ABCAF271C", "7z"), ("504B0304", "zip")):
        out = F.when(F.startswith(head, F.lit(magic)), kind).otherwise(out)
    return out


def staged_name(url: Column, extension: Column) -> Column:
    """A file name from an address: its cleaned last part, a hundred characters at most, and the address's hash."""
    last = F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)
    clean = F.substring(F.regexp_replace(F.regexp_replace(last, r"\.[^.]*$", ""), r"[^A-Za-z0-9._-]+", "_"), 1, 100)
    return F.concat(clean, F.lit("_"), item_hash(url), F.lit("."), extension)


def name_collisions(names: DataFrame, name: str) -> DataFrame:
    """Names claimed more than once."""
    return names.groupBy(name).agg(F.count(F.lit(1)).alias("claims")).filter("claims > 1")


def dedupe_entries(entries: DataFrame) -> DataFrame:
    """One row a path; ``conflict`` where a path stands for different contents."""
    return entries.groupBy("path").agg(F.min("crc").alias("crc"), (F.min("crc") != F.max("crc")).alias("conflict"))


def bbox_cells(boxes: DataFrame, step: float) -> DataFrame:
    """Each of ``boxes(west, south, east, north, ...)`` cut into cells of a step, the last ones ending with it; other columns stay with the cells."""
    number = lambda low, high: F.explode(F.when(F.col(high) > F.col(low), F.sequence(F.lit(0).cast("long"), F.ceil((F.col(high) - F.col(low)) / step).cast("long") - 1)))
    cut = boxes.withColumn("_i", number("west", "east")).withColumn("_j", number("south", "north"))
    low = lambda k, a: F.col(k) * step + F.col(a)
    high = lambda k, a, end: F.least((F.col(k) + 1) * step + F.col(a), F.col(end))
    cells = {"west": low("_i", "west"), "south": low("_j", "south"), "east": high("_i", "west", "east"), "north": high("_j", "south", "north")}
    return cut.withColumns({f"_{k}": c for k, c in cells.items()}).drop(*cells, "_i", "_j").withColumnsRenamed({f"_{k}": k for k in cells})


def source_maxzooms(files: DataFrame) -> DataFrame:
    return files.groupBy("source").agg(F.max("maxzoom").alias("maxzoom"))


def listing_guard(current: DataFrame, previous: DataFrame, worst: float = 0.05) -> DataFrame:
    """``source, now, before, duplicates, problem`` of each source of ``current(source, url, listed)``: what keeps its items from being written.

    A repeated address is one whatever the source; a listed one may not have shrunk by over ``worst`` against ``previous(source, url)``, an enumerated one may.
    """
    counts = current.groupBy("source", "url").agg(F.count(F.lit(1)).alias("n"), F.max("listed").alias("listed")).groupBy("source")
    now = counts.agg(F.sum("n").alias("now"), F.count(F.when(F.col("n") > 1, 1)).alias("duplicates"), F.max("listed").alias("_listed"))
    met = now.join(previous.groupBy("source").agg(F.count(F.lit(1)).alias("before")), "source", "left").withColumn("before", F.coalesce("before", F.lit(0)))
    shrunk = F.col("_listed") & (F.lit(1) - F.col("now") / F.nullif(F.col("before"), F.lit(0)) > worst)
    problem = F.when(F.col("duplicates") > 0, "duplicates").when(shrunk, "shrank")
    return met.select("source", "now", "before", "duplicates", problem.alias("problem"))


def probe(values: DataFrame) -> DataFrame:
    """Least, greatest and mean value of each source, and whether its depths are positive-down."""
    stats = values.groupBy("source").agg(F.min("z").alias("low"), F.max("z").alias("high"), F.avg("z").alias("mean"))
    return stats.withColumn("negate", (F.col("low") >= 0) | ((F.col("high") > -F.col("low")) & (F.col("mean") > 0)))


def glob_column(globs: Column) -> Column:
    """``glob_pattern`` of a column."""
    literal = F.regexp_replace(F.lower(globs), r"([.\+^$(){}\[\]])", r"\\$1")
    return F.concat(F.lit("^(?:"), F.regexp_replace(F.regexp_replace(literal, r"\*", ".*"), r"\?", "."), F.lit(")$"))


def enumerate_source(sources: DataFrame, entries: DataFrame, listing: DataFrame) -> DataFrame:
    """What each source offers: ``source, url, listed, problem``; a source with a problem has rows of it instead of items.

    ``sources(source, filter, dedupe)`` are recipes, ``entries(source, entry)`` their lists, ``listing(entry, url, cell, modified)`` what
    stands under an entry. Without a filter the list is the enumeration, and neither prefixes (entries that end with a slash) nor a
    choice of the newest go with it. With one, listed addresses that pass are the items, the newest of each cell if ``dedupe`` is
    ``newest``, for which each needs a time; a filter that nothing passes is a problem.
    """
    entered = entries.join(sources, "source")
    static, listed = entered.filter("filter is null"), entered.filter("filter is not null")
    wrong = F.when(F.col("dedupe").isNotNull(), "dedupe without filter").when(F.endswith("entry", F.lit("/")), "prefix without filter")
    echoed = static.select("source", F.col("entry").alias("url"), F.lit(False).alias("listed"), wrong.alias("problem"))
    candidates = listed.join(listing, "entry").select("source", "dedupe", "filter", "url", "cell", "modified")
    passing = candidates.filter(F.regexp_like(F.lower("url"), glob_column(F.col("filter"))))
    facts = passing.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("modified").alias("timed"))
    fault = F.when(~F.col("dedupe").isin("newest"), "unknown dedupe").when(F.col("n").isNull(), "filter passes nothing").when(F.col("dedupe").isNotNull() & (F.col("timed") < F.col("n")), "dedupe without times")
    faults = sources.filter("filter is not null").join(facts, "source", "left").select("source", fault.alias("problem"))
    clean = passing.join(faults.filter("problem is null").select("source"), "source", "left_semi")
    newest = clean.filter("dedupe = 'newest'").groupBy("source", "cell").agg(F.max_by("url", F.struct("modified", "url")).alias("url")).select("source", "url")
    items = clean.filter("dedupe is null").select("source", "url").distinct().unionByName(newest).select("source", "url", F.lit(True).alias("listed"), F.lit(None).cast("string").alias("problem"))
    bad = echoed.filter("problem is not null").select("source", "problem").distinct().unionByName(faults.filter("problem is not null"))
    problems = bad.select("source", F.lit(None).cast("string").alias("url"), F.lit(None).cast("boolean").alias("listed"), "problem")
    return echoed.join(bad.select("source").distinct(), "source", "left_anti").unionByName(items).unionByName(problems)


def register_raw(listed: DataFrame, previous: DataFrame, tolerance: int = 5) -> DataFrame:
    """The next registration: ``source, key, registered, value, origin, healthy, refused``.

    ``listed(source, key, cell, value)`` has a null value where the header couldn't be read; ``previous(source, key, cell, value)`` is what
    was registered. A registered key keeps its row (``kept``), a new one brings what was read (``read``), a broken one takes its
    cell's previous row (``carried``; of several the greatest key) or goes. Broken ones aren't ``healthy``: nothing may fetch them. A source with
    more broken keys than tolerated is ``refused`` as a whole.
    """
    known = previous.groupBy("source", "key").agg(F.first("value").alias("_known"), F.lit(True).alias("_had"))
    cells = previous.filter("cell is not null").groupBy("source", "cell").agg(F.max(F.struct("key", "value")).alias("_cell"))
    once = listed.groupBy("source", "key").agg(F.first("cell").alias("cell"), F.first("value", ignorenulls=True).alias("value"))
    met = once.join(known, ["source", "key"], "left").join(cells, ["source", "cell"], "left")
    origin = F.when(F.col("_had"), "kept").when(F.col("value").isNotNull(), "read").when(F.col("_cell").isNotNull(), "carried").otherwise("broken")
    rows = met.withColumn("origin", origin).withColumn("healthy", F.col("origin").isin("kept", "read"))
    broken = rows.groupBy("source").agg((F.count(F.when(~F.col("healthy"), 1)) > tolerance).alias("refused"))
    at = lambda kept, read, carried: F.when(F.col("origin") == "kept", kept).when(F.col("origin") == "read", read).otherwise(carried)
    out = rows.filter("origin <> 'broken'").join(broken, "source")
    return out.select("source", "key", at(F.col("key"), F.col("key"), F.col("_cell.key")).alias("registered"), at(F.col("_known"), F.col("value"), F.col("_cell.value")).alias("value"), "origin", "healthy", "refused")


# The kinds of bytes that a declared format may have.
DECLARED = {
    "zip": ("zip",),
    "asc-mosaic": ("zip",),
    "asc-tile": ("zip", "7z"),
    "tar.gz": ("gzip",),
    "e00": ("gzip",),
    "gldb": ("gzip",),
    "7z": ("7z",),
    "netcdf": ("netcdf",),
}


def declared_problem(declared: Column, content: Column) -> Column:
    """Why bytes aren't what their declaration says; null where they are, or where nothing is declared."""
    kind = kind_sniff(content)
    fits = F.lit(False)
    for name, kinds in DECLARED.items():
        fits = fits | ((declared == name) & kind.isin(*kinds))
    return F.when(declared.isNull() | fits, None).when(~declared.isin(*DECLARED), F.concat(F.lit("unknown format "), declared)).otherwise(F.concat(F.lit("declared "), declared, F.lit(", found "), kind))


def staged_parts(published: DataFrame, staged: DataFrame) -> DataFrame:
    """``key, problem`` of staged parts that aren't what was published: missing, of another size, of another digest, or left over.

    ``published(key, size, etag)``; ``staged(key, size, digest)`` as ``binaryFile`` and ``md5`` give it. A tag with a dash is a
    digest of digests, and the size stands alone.
    """
    there = staged.select("key", F.col("size").alias("_size"), "digest")
    both = published.join(there, "key", "full_outer")
    plain = ~F.contains("etag", F.lit("-")) & (F.lower("etag") != F.lower("digest"))
    problem = F.when(F.col("size").isNull(), "left over").when(F.col("_size").isNull(), "missing").when(F.col("size") != F.col("_size"), "size").when(plain, "digest")
    return both.select("key", problem.alias("problem")).filter("problem is not null")
