"""Judges urls by host and path rules with a sort-merge range join.

A host is reversed label by label, so that a host and its subdomains share a prefix. A url has
one key for every suffix of its host that is no longer than the longest rule host: (reversed
suffix, path). In the order of these keys a rule covers one interval, which begins at (its
reversed host, its path), and two intervals are nested or apart. A sweep over rules and urls in
that order keeps the stack of rules that are open where the last rule began; the url takes the
deepest rule of the stack whose path begins its own path.

The sweep is dealt by row, not by host: every bucket gets an equal share of the urls and all
rules, so a host that holds a third of the rows is no bottleneck. There are never so many
buckets that rule copies exceed a tenth of the url rows (with one bucket as the least).

Defined cases: null urls and urls without ``://`` have an empty host and path and fit no rule
with a host; repeated rows stay; without rules or rows nothing fails; an input column named
like an output column is replaced. Only built-in column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import ascii_lower, others, partitions, stored, table

OUTPUTS = ("host", "path", "rule", "verdict")

# The rules of the registered query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Rules with the stack of rules open where they begin, outermost first.

    Ancestors are found by joining every beginning of a rule's path with the rules.
    """
    keyed = rules.where("host is not null").select(
        reversed_host(F.col("host")).alias("site"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"),
        "verdict",
    )
    # of equal rules the one that blocks holds
    one = keyed.groupBy("site", "path", "rule").agg(F.max("verdict").alias("verdict"))
    starts = one.select(
        "site", "path",
        F.explode(F.sequence(F.lit(0), F.length("path"))).alias("n"),
    ).select("site", "path", F.expr("left(path, n)").alias("start"))
    opened = one.select(
        "site", F.col("path").alias("start"),
        F.struct(F.length("path").alias("depth"), "path", "rule", "verdict").alias("entry"),
    )
    return (
        starts.join(opened, ["site", "start"])
        .groupBy("site", "path")
        .agg(F.array_sort(F.collect_list("entry")).alias("stack"))
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Input rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has verdict, host and path. The longest rule that fits decides, else ``default``.
    """
    spark, columns = urls.sparkSession, others(urls, OUTPUTS)
    stacks = stored(rule_stacks(rules), "url-rules")
    n_rules, labels = stacks.agg(
        F.count("*"), F.max(F.size(F.split("site", r"\.", -1)))
    ).first()
    n_urls = urls.count()
    buckets = max(1, min(
        max(4 * partitions(spark), n_urls // 1_000_000), n_urls // (10 * max(1, n_rules)),
    ))
    row = F.monotonically_increasing_id()
    parsed = urls.select(
        row.alias("_row"), F.struct(*columns).alias("_all") if columns else F.lit(None).alias("_all"),
        host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"),
    ).withColumn("_labels", F.reverse(F.split("_host", r"\.", -1)))
    most = F.least(F.size("_labels"), F.lit(labels or 1))
    # the shortest suffix carries the row, the others only its number
    suffixes = parsed.select(
        F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int").alias("bucket"), "_row",
        F.explode(F.sequence(F.lit(1), most)).alias("n"), "_labels", "_path", "_host", "_all",
    ).select(
        "bucket", "_row", F.array_join(F.slice("_labels", 1, F.col("n")), ".").alias("site"),
        F.col("_path").alias("path"), F.lit(1).alias("kind"),
        F.when(F.col("n") == 1, F.struct("_host", "_path", "_all")).alias("carried"),
    )
    entries = stacks.schema["stack"].dataType.simpleString()
    events = suffixes.withColumn("open", F.lit(None).cast(f"struct<site:string,stack:{entries}>")).unionByName(
        stacks.select(
            F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "site", "path",
            F.lit(0).alias("kind"), F.struct("site", "stack").alias("open"),
        ),
        allowMissingColumns=True,
    )
    sweep = (
        Window.partitionBy("bucket").orderBy("site", "path", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    fits = F.filter("open.stack", lambda entry: F.startswith(F.col("path"), entry["path"]))
    found = (
        events.withColumn("open", F.last("open", ignorenulls=True).over(sweep))
        .where("kind = 1")
        .withColumn("fit", F.when(F.col("open.site") == F.col("site"), F.try_element_at(fits, F.lit(-1))))
        .select(
            "bucket", "_row", "carried",
            F.when(
                F.col("fit").isNotNull(),
                F.struct(
                    F.length("fit.rule").alias("n"), F.length("site").alias("site"),
                    F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"),
                ),
            ).alias("fit"),
        )
    )
    judged = found.groupBy("bucket", "_row").agg(
        F.first("carried", ignorenulls=True).alias("c"), F.max("fit").alias("fit")
    )
    return judged.select(
        *([F.col(f"c._all.{name}") for name in columns]),
        F.col("c._host").alias("host"), F.col("c._path").alias("path"), F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.lit(default)).alias("verdict"),
    )


def op3_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    names = ("verdict", "host", "path")
    rules = spark.range(1).select(F.inline(F.array(*(
        F.struct(*(F.lit(value).alias(name) for name, value in zip(names, rule))) for rule in RULES
    ))))
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
with rules(verdict, host, path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts as (
  select row_number() over () as n, page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select n, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
ranked as (
  select s.n, s.page_id, s.host, s.path, r.host || r.path as rule, r.verdict,
    row_number() over (partition by s.n order by length(r.host || r.path) desc nulls last) as k
  from split s left join rules r
    on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path))
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule,
  coalesce(verdict, 'allow') as verdict
from ranked where k = 1
"""
