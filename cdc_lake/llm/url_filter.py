"""URL filters from dated lists: each capture against the entries in force when it was fetched.

An entry is listed or delisted at a time. Runs of entries on the same rule become validity
intervals, and captures are joined as of their fetch time with the rules that can hold for
them: their host, the domains above it, and the leading folders of their path. Column
functions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Entries have these kinds, and list or delist a value.
KINDS = ("host", "domain", "path")
LISTED, DELISTED = "add", "remove"


def host_of(url: Column) -> Column:
    """Host of an absolute URL, lower case, without user, port or final dot; null if none."""
    authority = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")
    return F.when(host != "", F.regexp_replace(host, r"\.$", ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def rule_keys(url: Column) -> Column:
    """Every (kind, value) that could hold for a URL; one with nulls if it has no host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    )
    folders = F.split(F.regexp_extract(path_of(url), r"(?s)^(.*)/", 1), "/")
    folders = F.filter(folders, lambda folder: folder != "")
    paths = F.when(F.size(folders) > 0, F.transform(
        F.sequence(F.lit(1), F.size(folders)), lambda i: key("path", F.concat(host, F.lit("/"), F.array_join(F.slice(folders, 1, i), "/"), F.lit("/")))
    )).otherwise(F.array().cast("array<struct<kind:string,value:string>>"))
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("value")))
    return F.when(host.isNull(), nothing).otherwise(F.concat(F.array(key("host", host)), domains, paths))


def validity(entries: DataFrame) -> DataFrame:
    """``kind, value, list_name, since, until``: when each rule of each list holds.

    ``until`` is exclusive and null while the rule still holds. Entries with a null, or with
    another action, count for nothing; of several at one time a delisting wins.
    """
    usable = entries.where(F.col("action").isin(LISTED, DELISTED)).dropna(subset=["kind", "value", "list_name", "at"])
    rule = ["list_name", "kind", "value"]
    # One row per rule and time; "remove" sorts after "add".
    states = usable.groupBy(*rule, "at").agg(F.max("action").alias("action"))
    by_time = Window.partitionBy(*rule).orderBy("at")
    states = states.withColumn("_prior", F.lag("action").over(by_time))
    changes = states.where((F.col("action") != F.coalesce("_prior", F.lit(DELISTED))))
    spans = changes.withColumn("until", F.lead("at").over(by_time))
    return spans.where(F.col("action") == LISTED).select(*rule, F.col("at").alias("since"), "until")


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, url, fetched_at, blocked, n_rules, lists``: a row per distinct capture.

    ``captures`` needs ``page_id, url, fetched_at``; ``entries`` needs ``list_name, kind, value,
    action, at``. ``lists`` names the lists with a rule in force, sorted and comma-joined (empty:
    none), ``n_rules`` counts such rules. A null or host-less URL or a null time meets no rule.
    Repeated captures come out once. No entries: nothing is blocked.
    """
    wanted = captures.select("page_id", "url", "fetched_at", F.explode(rule_keys(F.col("url"))).alias("_key"))
    wanted = wanted.select("page_id", "url", "fetched_at", F.col("_key.kind").alias("kind"), F.col("_key.value").alias("value"))
    rules = validity(entries).withColumnsRenamed({"kind": "_kind", "value": "_value"})
    # An expression of the keys: both sides are shuffled for the join itself, so that AQE can split a hot host.
    same = (wanted["value"] == rules["_value"]) & (F.concat(wanted["kind"], F.lit(":")) == F.concat(rules["_kind"], F.lit(":")))
    in_force = (rules["since"] <= wanted["fetched_at"]) & (rules["until"].isNull() | (wanted["fetched_at"] < rules["until"]))
    met = wanted.join(rules, same & in_force, "left")
    by_capture = met.groupBy("page_id", "url", "fetched_at").agg(
        F.collect_set(F.when(F.col("list_name").isNotNull(), F.struct("list_name", "kind", "value"))).alias("_met")
    )
    lists = F.array_join(F.sort_array(F.array_distinct(F.col("_met.list_name"))), ",").alias("lists")
    return by_capture.select(
        "page_id", "url", "fetched_at", (F.size("_met") > 0).alias("blocked"), F.size("_met").cast("long").alias("n_rules"), lists
    )
