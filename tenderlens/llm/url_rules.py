"""Rules on hosts and paths by a sort-merge range join, with built-in functions only.

The labels of a host are reversed, so a rule's host and all its subdomains are the keys that
start with one prefix: an interval of the sorted keys.  Rules and keys are sorted together, and a sweep
carries the stack of rules that the last opened rule stands in; the rules of the stack that
hold the key are those whose interval is still open.  Paths are swept first, which gives every
address the rule paths that begin its own path; hosts are swept within each rule path.

Keys and rules are dealt out together by sorted ranges with a salt, so a host with a third of all rows is
cut into several ranges, and each range starts with the rules that are open at its first key.  These are
found by joining the beginnings of that key with the rules by equality.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.llm.common import stored


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path of an address; both empty without ``://``, and for NULL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def reversed_host(host: Column) -> Column:
    """Canonical key of a host: its labels from the last to the first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(prefixes: DataFrame) -> DataFrame:
    """``prefix`` with ``stack``: the given prefixes that begin it, shortest first, itself last."""
    own = prefixes.select("prefix").distinct()
    parts = own.select(
        "prefix", F.explode(F.sequence(F.lit(0), F.length("prefix"))).alias("n")
    ).select("prefix", F.substring("prefix", F.lit(1), F.col("n")).alias("part"))
    outer = own.select(F.col("prefix").alias("outer"))
    return parts.join(outer, F.col("part") == F.col("outer")).groupBy("prefix").agg(
        F.array_sort(F.collect_list("outer")).alias("stack")
    )


def sweep(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``keys`` with ``open``: the prefixes that begin ``key``, shortest first.

    ``keys`` has a column ``key`` without NULLs, and the column ``prefix`` of ``prefixes`` has none.
    """
    stacks = stored(_stacks(prefixes))
    row = F.struct(*keys.columns)
    found = keys.select(F.col("key").alias("at"), F.lit(1).alias("kind"), F.xxhash64(*keys.columns).alias("salt"),
                        row.alias("row"), F.lit(None).cast("array<string>").alias("stack"))
    no_row = F.lit(None).cast(found.schema["row"].dataType)
    rules = stacks.select(F.col("prefix"), F.lit(0), F.lit(0).cast("bigint"), no_row, F.col("stack"))
    events = found.union(rules).repartitionByRange("at", "kind", "salt")
    events = stored(events.select(F.spark_partition_id().alias("range"), "at", "kind", "row", "stack"))

    # The longest rule that begins the first key of a range has all others that do in its stack.
    low = events.groupBy("range").agg(F.min("at").alias("low"))
    parts = low.select("range", "low", F.explode(F.sequence(F.lit(0), F.length("low"))).alias("n")).select(
        "range", "low", F.substring("low", F.lit(1), F.col("n")).alias("part"))
    opened = parts.join(stacks, F.col("part") == F.col("prefix")).groupBy("range", "low").agg(
        F.max_by("stack", F.length("prefix")).alias("stack"))
    events = events.union(opened.select("range", "low", F.lit(-1), no_row, "stack"))
    so_far = Window.partitionBy("range").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select("kind", "row", F.last("stack", ignorenulls=True).over(so_far).alias("stack")).where("kind = 1")
    still_open = F.filter(F.coalesce("stack", F.array().cast("array<string>")),
                          lambda prefix: F.startswith(F.col("row.key"), prefix))
    return swept.select("row.*", still_open.alias("open"))


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block).  A rule fits its host and all
    subdomains if the path starts with its own.  Of the rules that fit, the one with most characters of
    host and path together wins, then the longer host; a rule that is given with both verdicts blocks.  Rules with
    a NULL host or path are left out.  Without a rule, ``rule`` is NULL and the verdict is ``default``.
    The added columns replace columns of the same name; no rules, or no rows, are fine.
    """
    given = urls.select(F.struct("*").alias("row"))
    split = given.select(F.col(f"row.{url}").alias("url")).where("url is not null").distinct().select(
        "url", host_and_path(F.col("url"))[0].alias("host"), host_and_path(F.col("url"))[1].alias("path")
    )
    own_host = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rules = stored(rules.where("host is not null and path is not null").select(
        reversed_host(own_host).alias("r_key"), own_host.alias("r_host"), F.col("path").alias("r_path"), "verdict"
    ).groupBy("r_key", "r_host", "r_path").agg(F.max("verdict").alias("verdict")))  # block sorts after allow

    def in_path(rule_path: Column, key: Column) -> Column:
        return F.concat(F.length(rule_path).cast("string"), F.lit(":"), rule_path, key)

    by_path = sweep(split.withColumn("key", F.col("path")), rules.select(F.col("r_path").alias("prefix")))
    by_path = by_path.select("url", "host", F.explode("open").alias("r_path"))
    by_host = sweep(
        by_path.withColumn("key", in_path(F.col("r_path"), reversed_host(F.col("host")))),
        rules.select(in_path(F.col("r_path"), F.col("r_key")).alias("prefix")),
    )
    longest = by_host.select("url", F.try_element_at("open", F.lit(-1)).alias("found")).where("found is not null")
    named = rules.select(
        in_path(F.col("r_path"), F.col("r_key")).alias("name"), F.concat("r_host", "r_path").alias("rule"),
        F.length("r_host").alias("host_size"), "verdict",
    )
    best = longest.join(named, F.col("found") == F.col("name")).groupBy("url").agg(
        F.max(F.struct(F.length("rule").alias("size"), "host_size", "rule", "verdict")).alias("best")
    )
    best = stored(best.select(F.col("url").alias("judged"), "best.rule", "best.verdict"))
    row_host, row_path = host_and_path(F.col(f"row.{url}"))
    kept = [f"row.`{c}`" for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    return given.join(best, F.col(f"row.{url}") == F.col("judged"), "left").select(
        *kept, row_host.alias("host"), row_path.alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
