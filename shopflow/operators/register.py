"""Grouping domains of one shop: core names by suffix table, matches, domain sets, registration plan, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import states, urls
from shopflow.functions.states import display_name
from shopflow.operators.skew import number_rows, salted_join, top_per_key
from shopflow.schemas import MAX_DOMAINS_PER_SHOP, META_KEY

_LIMIT = MAX_DOMAINS_PER_SHOP


def core_domain_by_table(df: DataFrame, suffixes: DataFrame, domain: str = "domain") -> DataFrame:
    """Adds ``core_domain_name`` by the rules of a suffix table (column ``suffix``).

    A rule is a suffix, a wildcard (``*.ck``: any label before ``ck`` belongs to the suffix) or an exception
    (``!www.ck``: not so for this name). An exception goes first, then the rule with the most labels. A domain without
    a rule keeps its last label, a bare suffix has no name.
    """
    hosts = df.select(F.col(domain).alias("_d")).distinct()
    labels = F.split(urls.normalize_domain(F.col("_d")), r"\.")

    def tail(k: Column) -> Column:
        return F.array_join(F.slice("_l", F.size("_l") - k + 1, k), ".")

    def rules(k: Column) -> Column:
        """Rules that a name with these last ``k`` labels can meet, with the number of labels of the suffix."""
        wild = F.when(k > 1, F.concat(F.lit("*."), tail(F.greatest(k - 1, F.lit(1)))))
        return F.array(F.struct(tail(k).alias("suffix"), k.alias("n"), F.lit(False).alias("exact")), F.struct(wild.alias("suffix"), k.alias("n"), F.lit(False).alias("exact")),
                       F.struct(F.concat(F.lit("!"), tail(k)).alias("suffix"), (k - 1).alias("n"), F.lit(True).alias("exact")))

    every = F.flatten(F.transform(F.sequence(F.lit(1), F.size("_l")), rules))
    asked = hosts.select("_d", labels.alias("_l")).select("_d", "_l", F.explode(every).alias("r")).select("_d", "_l", "r.*")
    met = asked.join(suffixes.select("suffix").distinct().withColumn("_hit", F.lit(True)), "suffix", "left")
    best = F.max(F.when(F.col("_hit"), F.struct("exact", "n")))["n"]
    cores = met.groupBy("_d").agg(best.alias("_n"), F.first("_l").alias("_l"))
    name = F.when(F.col("_n").isNull(), F.element_at("_l", -1)).when(
        F.size("_l") > F.col("_n"), F.get("_l", F.size("_l") - F.col("_n") - 1)).otherwise(F.lit(""))
    named = cores.select(F.col("_d").alias(domain), name.alias("core_domain_name"))
    return df.drop("core_domain_name").join(named, domain, "left")


def new_shops(changes: DataFrame, suffixes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Change records to (new shops, rejects). Only inserted shop rows count; one without a domain is a reject.

    Core names follow the table ``suffixes``, if there is one.
    """
    image = F.col("dynamodb.NewImage")

    def attribute(name: str):
        return image[name]["S"]

    key = attribute("pk")
    domain = F.coalesce(F.nullif(attribute("domain"), F.lit("")),
                        F.when(key.startswith("SHOP#"), states.domain_from_key(key)))
    shops = (changes.where((F.col("eventName") == "INSERT") & (attribute("sk") == META_KEY))
             .select(F.coalesce(F.col("dynamodb.SequenceNumber"), F.lit("UNKNOWN")).alias("sequence_number"),
                     F.nullif(domain, F.lit("")).alias("domain"), attribute("shop_name").alias("shop_name"),
                     attribute("shop_image").alias("shop_image"),
                     states.shop_type(attribute("shop_type")).alias("shop_type"))
             .withColumn("core_domain_name", urls.core_domain(F.col("domain"))))
    named = shops.where(F.col("domain").isNotNull())
    return (named if suffixes is None else core_domain_by_table(named, suffixes).select(*shops.columns),
            shops.where(F.col("domain").isNull()).select("sequence_number", F.lit("MISSING_DOMAIN").alias("error")))


def _first_domains(shops: DataFrame, n: int, name: str) -> DataFrame:
    """The first ``n`` domains per core name as a sorted list, bounded by ``n``."""
    top = top_per_key(shops.select("core_domain_name", "domain").distinct(), ["core_domain_name"], [F.col("domain")], n)
    return top.groupBy("core_domain_name").agg(F.array_sort(F.collect_list("domain")).alias(name))


def match_existing(new: DataFrame, shops: DataFrame) -> DataFrame:
    """Each new shop with the first other domain of its core name as ``identifier`` (null: none) and the number of others.

    The others themselves are the rows of :func:`domain_sets` with its core name.
    """
    sets = domain_sets(shops)
    first = top_per_key(sets, ["core_domain_name"], [F.col("domain")], 2).groupBy("core_domain_name").agg(
        F.array_sort(F.collect_list("domain")).alias("_first"), F.max("n_domains").alias("_n"))
    own = new.select("domain", "core_domain_name").join(sets.select("domain", F.lit(1).alias("_own")), "domain", "left")
    joined = own.join(first, "core_domain_name", "left")
    return joined.select("domain", "core_domain_name", F.get(F.filter("_first", lambda d: d != F.col("domain")), F.lit(0)).alias("identifier"),
                         (F.coalesce("_n", F.lit(0)) - F.coalesce("_own", F.lit(0))).cast("long").alias("n_existing"))


def domain_sets(shops: DataFrame) -> DataFrame:
    """One row per core name and domain, all of them, with the number of domains of the core name."""
    rows = shops.select("core_domain_name", "domain").distinct()
    return rows.join(rows.groupBy("core_domain_name").agg(F.count(F.lit(1)).alias("n_domains")), "core_domain_name")


def registration_plan(new: DataFrame, shops: DataFrame, **options) -> DataFrame:
    """One request per new shop: PATCH the first known domain with all domains, or POST a new shop.

    New shops of one batch are taken in domain order, as if they came one after another: the first of an unknown core
    name creates the shop, the next ones join it. A list above 100 domains is an error row.
    """
    fresh = top_per_key(new, ["domain"], [F.col("domain")])
    known = _first_domains(shops.join(fresh.select("domain"), "domain", "left_anti"), _LIMIT + 1, "_known")
    batch = _first_domains(fresh, _LIMIT + 1, "_batch")
    numbered = number_rows(fresh, ["core_domain_name"], ["domain"], "_k", **options)
    per_core = batch.join(known, "core_domain_name", "left")
    joined = salted_join(numbered, per_core, ["core_domain_name"], ["domain"])
    none = F.array().cast("array<string>")
    earlier = F.slice("_batch", F.lit(1), F.least(F.col("_k") - 1, F.size("_batch")).cast("int"))
    before = F.concat(F.coalesce("_known", none), earlier)
    total = F.coalesce(F.size("_known"), F.lit(0)) + F.col("_k")
    planned = joined.withColumn("_before", before).withColumn("_over", total > _LIMIT)
    patch = F.size("_before") > 0
    name = display_name(F.col("shop_name"), F.col("core_domain_name"), urls.core_domain(F.col("domain")))
    return planned.select(
        "domain", "core_domain_name", F.when(patch, "PATCH").otherwise("POST").alias("action"),
        F.get("_before", 0).alias("identifier"),
        F.when(~F.col("_over"), F.concat("_before", F.array("domain"))).alias("domains"),
        F.when(~patch, name).alias("name"), F.when(~patch, states.shop_type(F.col("shop_type"))).alias("shop_type"),
        F.when(~patch, F.col("shop_image")).alias("image"),
        F.when(F.col("_over"), "TOO_MANY_DOMAINS").alias("error"))


def uniqueness_violations(shops: DataFrame) -> DataFrame:
    """Slugs and domains that belong to more than one shop. ``shops`` is (shop_id, name, domains)."""
    slugs = shops.select(F.lit("slug").alias("kind"), urls.shop_slug(F.col("name")).alias("value"), "shop_id")
    domains = shops.select(F.lit("domain").alias("kind"), F.explode("domains").alias("value"), "shop_id")
    return (slugs.unionByName(domains).distinct().groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_shops"))
            .where(F.col("n_shops") > 1))
