from __future__ import annotations

from pyspark.sql import functions as F

from catalog_queries.registry import query
from catalog_queries.tables import HOSTS_SQL, sites
from shopflow.operators import register as R
from shopflow.plans import jobs


@query(f"WITH {HOSTS_SQL} SELECT domain, core AS core_domain_name FROM site")
def core_domain(read):
    return sites(read).select("domain", "core_domain_name")


@query("""WITH h AS (SELECT DISTINCT regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)), '^www\\.', '') AS domain FROM pages)
SELECT domain, CASE WHEN domain LIKE '%.example.com' THEN string_split(domain, '.')[-3] WHEN domain LIKE '%.net' THEN string_split(domain, '.')[-2]
  ELSE string_split(domain, '.')[-1] END AS core_domain_name FROM h""")
def core_domain_by_table(read):
    """Longest suffix of a table of hosts seen in the pages: ``com``, ``example.com`` and ``net``."""
    hosts = sites(read).select("domain")
    tail = F.split("domain", r"\.")
    suffixes = (hosts.select(F.element_at(tail, -1).alias("suffix")).where(F.col("suffix").isin("com", "net"))
                .unionByName(hosts.where(F.col("domain").endswith(".example.com")).select(F.lit("example.com").alias("suffix"))))
    return R.core_domain_by_table(hosts, suffixes)


@query("""WITH h AS (SELECT DISTINCT regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)), '^www\\.', '') AS domain FROM pages),
l AS (SELECT domain, string_split(domain, '.') AS l FROM h)
SELECT domain, CASE WHEN l[-1] = 'com' THEN CASE WHEN l[-2] = 'example' THEN l[-3] ELSE l[-2] END
  WHEN l[-1] = 'net' THEN CASE WHEN domain LIKE 'm.%' AND len(l) = 4 THEN l[1] WHEN l[-2] = 'example' THEN coalesce(l[-4], '') ELSE l[-2] END
  ELSE l[-1] END AS core_domain_name FROM l""")
def core_domain_by_rules(read):
    """Normal, wildcard and exception rules: ``example.com``, ``*.example.net``, and an exception for each host ``m.<shop>.example.net``."""
    hosts = sites(read).select("domain")
    fixed = F.array(*[F.lit(r) for r in ("com", "net", "example.com", "*.example.net")])
    suffixes = (hosts.agg(F.any_value(fixed).alias("f")).select(F.explode("f").alias("suffix")).unionByName(
        hosts.where(F.col("domain").rlike(r"^m\.[^.]+\.example\.net$")).select(F.concat(F.lit("!"), "domain").alias("suffix"))))
    return R.core_domain_by_table(hosts, suffixes)


def _split(read):
    named = sites(read).withColumns({"shop_name": F.lit(None).cast("string"), "shop_type": F.lit("NONE"), "shop_image": F.lit(None).cast("string")})
    new = named.where(F.col("first_page") % 2 == 1)
    return new, named.where(F.col("first_page") % 2 == 0)


@query(f"""WITH {HOSTS_SQL} SELECT n.domain, n.core AS core_domain_name, min(o.domain) AS identifier, count(o.domain) AS n_existing
  FROM site n LEFT JOIN site o ON o.core = n.core AND o.domain <> n.domain WHERE n.first_page % 2 = 1 GROUP BY n.domain, n.core""")
def same_shop(read):
    new, _ = _split(read)
    return R.match_existing(new, sites(read))


@query(f"""WITH {HOSTS_SQL} SELECT core AS core_domain_name, domain, count(*) OVER (PARTITION BY core) AS n_domains FROM site""")
def domain_sets(read):
    return R.domain_sets(sites(read))


PLAN_SQL = f"""{HOSTS_SQL},
known AS (SELECT core, list(domain ORDER BY domain) AS k FROM site WHERE first_page % 2 = 0 GROUP BY core),
new AS (SELECT domain, core, row_number() OVER w AS n, list(domain) OVER (PARTITION BY core ORDER BY domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
  FROM site WHERE first_page % 2 = 1 WINDOW w AS (PARTITION BY core ORDER BY domain)),
plan AS (SELECT domain, core, n + coalesce(len(k), 0) > 100 AS over_limit, list_concat(coalesce(k, []), coalesce(b, [])) AS before FROM new LEFT JOIN known USING (core))
SELECT domain, core AS core_domain_name, CASE WHEN len(before) > 0 THEN 'PATCH' ELSE 'POST' END AS action, before[1] AS identifier,
  CASE WHEN NOT over_limit THEN array_to_string(list_append(before, domain), ',') END AS domains, CASE WHEN len(before) = 0 THEN core END AS name,
  CASE WHEN len(before) = 0 THEN 'COMMERCIAL_DEALER' END AS shop_type, CASE WHEN over_limit THEN 'TOO_MANY_DOMAINS' END AS error FROM plan"""


@query(f"WITH {PLAN_SQL}")
def registration_plan(read):
    new, known = _split(read)
    return R.registration_plan(new, known).drop("image").withColumn("domains", F.array_join("domains", ","))


@query(f"WITH {PLAN_SQL}")
def register_job(read):
    """The same plan from change records; modified rows and URL rows among them do not count."""
    new, known = _split(read)

    def text(name, value):
        return F.concat(F.lit(f'"{name}":{{"S":"'), value, F.lit('"}'))

    image = F.concat(F.lit("{"), text("pk", F.concat(F.lit("SHOP#"), "domain")), F.lit(","), text("sk", F.lit("META#")), F.lit("}"))
    kinds = F.explode(F.array(F.lit("INSERT"), F.lit("MODIFY")))
    records = new.withColumn("eventName", kinds).select("eventName", F.struct(
        F.from_json(image, "map<string,struct<S:string>>").alias("NewImage"), F.col("first_page").cast("string").alias("SequenceNumber")).alias("dynamodb"))
    return jobs.register_shops(records, known)["plan"].drop("image").withColumn("domains", F.array_join("domains", ","))


@query(f"""WITH {HOSTS_SQL} SELECT 'slug' AS kind, core AS value, count(DISTINCT domain) AS n_shops FROM site GROUP BY core HAVING count(DISTINCT domain) > 1
UNION ALL SELECT 'domain', regexp_replace(domain, '^[^.]*\\.', ''), count(DISTINCT domain) FROM site GROUP BY 2 HAVING count(DISTINCT domain) > 1""")
def uniqueness_violations(read):
    rows = sites(read).select(F.col("domain").alias("shop_id"), F.col("core_domain_name").alias("name"),
                              F.array(F.regexp_replace("domain", r"^[^.]*\.", "")).alias("domains"))
    return R.uniqueness_violations(rows)
