"""Access audits over the whole request log.

Every logged request is evaluated against the permission rows: what its role is allowed
(expected) beside what the governed surface enforces for it. Requests are first counted by
what decides them, combined before the shuffle, so one busy role costs a row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.operators import access as A
from innspark.plans.registry import model
from innspark.sources.fixtures import read_base
from innspark.sources.seeds import DOMAINS

#: the roles of the permission rows, in the order in which users hold them here
ROLES = sorted({role for pairs in A.ROLE_CHAINS.values() for pair in pairs for role in pair})

_ROLE = "case cast(user_id % {n} as int) {cases} end".format(
    n=len(ROLES) + 1, cases=" ".join(f"when {k} then '{r}'" for k, r in enumerate(ROLES)))  # the last one holds none
_DOMAIN = "case cast(event_id % {n} as int) {cases} end".format(
    n=len(DOMAINS), cases=" ".join(f"when {k} then '{d}'" for k, d in enumerate(DOMAINS)))
REQUESTS = (f"{_ROLE} AS role_title", f"{_DOMAIN} AS data_domain",
            "concat('E', lpad(cast(user_id as string), 6, '0')) AS employee_id",
            "concat('P0', cast(event_id % 5 + 1 as string)) AS claimed_property_id", "ts AS requested_at")

model("log_requests", "log", f"SELECT {', '.join(REQUESTS)} FROM events", tags=("log",))(
    lambda m: read_base(m.spark, m.sf_dir, "events").selectExpr(*REQUESTS))


def matrix_audit(perms: DataFrame, requests: DataFrame, domains=DOMAINS) -> DataFrame:
    """F8: every role x domain cell with its requests, granted and refused, and whether the
    enforced scope of all of them is the expected one. Roles that are only requested with,
    and null ones, have their cells too; they expect a refusal."""
    asked = requests.groupBy("role_title", "data_domain").agg(F.count(F.lit(1)).alias("requests"))
    enforced = A.authorize(perms, asked)
    cells = (perms.select("role_title").union(requests.select("role_title")).distinct()
             .select("role_title", F.explode(F.array(*[F.lit(d) for d in domains])).alias("data_domain")))
    expected = perms.select("role_title", "data_domain", F.col("access_scope").alias("expected_scope"))
    out = cells.join(expected, ["role_title", "data_domain"], "left").withColumn(
        "expected_scope", F.coalesce("expected_scope", F.lit("deny")))
    e = enforced.select(F.col("role_title").alias("r"), F.col("data_domain").alias("d"), "requests", "access_scope")
    out = out.join(e, F.col("role_title").eqNullSafe(F.col("r")) & (F.col("data_domain") == F.col("d")), "left")
    n = F.coalesce("requests", F.lit(0))
    return out.select("role_title", "data_domain", "expected_scope", n.alias("requests"),
                      F.when(F.col("access_scope") != "deny", n).otherwise(0).cast("long").alias("granted"),
                      F.when(F.col("access_scope") == "deny", n).otherwise(0).cast("long").alias("refused"),
                      F.coalesce(F.col("access_scope") == F.col("expected_scope"), F.lit(True)).alias("match"))


def superset_audit(perms: DataFrame, requests: DataFrame, pairs: DataFrame) -> DataFrame:
    """for each (lower, higher) pair of roles, the lower role's granted requests and how
    many of them the higher role would be refused."""
    granted = A.authorize(perms, requests.groupBy("role_title", "data_domain").agg(
        F.count(F.lit(1)).alias("n"))).where("access_scope != 'deny'")
    low = pairs.join(granted.select(F.col("role_title").alias("lower_role"), "data_domain", "n"), "lower_role", "left")
    high = perms.select(F.col("role_title").alias("higher_role"), "data_domain", F.lit(True).alias("held"))
    return low.join(high, ["higher_role", "data_domain"], "left").groupBy("chain", "lower_role", "higher_role").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("granted_requests"),
        F.coalesce(F.sum(F.when(F.col("held").isNull(), F.col("n"))), F.lit(0)).alias("refused_to_higher"))


def override_audit(perms: DataFrame, employees: DataFrame, requests: DataFrame) -> DataFrame:
    """what happens to the property that requests claim, by domain and enforced scope:
    with own_property the employee's own one is enforced whatever is claimed, and a request
    whose employee isn't in the directory is refused."""
    decided = A.resolve_property(employees, A.authorize(perms, requests))
    own = F.col("access_scope") == "own_property"
    enforced = F.when(own, F.col("resolved_property_id")).when(
        F.col("access_scope") == "all_properties", F.col("claimed_property_id"))
    d = decided.withColumn("enforced", enforced)
    return d.groupBy("data_domain", "access_scope").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(own & (F.col("enforced") != F.col("claimed_property_id"))).alias("overridden"),
        F.count_if(own & F.col("enforced").isNull()).alias("unresolved"),
        F.count_if(own & F.col("enforced").isNotNull() & (F.col("enforced") != F.col("resolved_property_id")))
        .alias("leaked"))


@model("access_matrix", "ops", f"""WITH cell AS (
  SELECT r.role_title, d.data_domain FROM (SELECT role_title FROM src_role_permissions
    UNION SELECT role_title FROM log_requests) r, (VALUES {', '.join(f"('{d}')" for d in DOMAINS)}) AS d(data_domain))
SELECT c.role_title, c.data_domain, coalesce(any_value(p.access_scope), 'deny') AS expected_scope,
  count(q.data_domain) AS requests, count(q.data_domain) FILTER (WHERE p.access_scope IS NOT NULL) AS granted,
  count(q.data_domain) FILTER (WHERE p.access_scope IS NULL) AS refused, true AS match
FROM cell c LEFT JOIN src_role_permissions p ON p.role_title = c.role_title AND p.data_domain = c.data_domain
LEFT JOIN log_requests q ON q.role_title IS NOT DISTINCT FROM c.role_title AND q.data_domain = c.data_domain
GROUP BY c.role_title, c.data_domain""", tags=("access",))
def access_matrix(m):
    return matrix_audit(m["src_role_permissions"], m["log_requests"])


_PAIRS = ", ".join(f"('{c}', '{lo}', '{hi}')" for c, pairs in A.ROLE_CHAINS.items() for lo, hi in pairs)


@model("access_supersets", "ops", f"""SELECT s.chain, s.lower_role, s.higher_role, count(p.data_domain) AS granted_requests,
  count(p.data_domain) FILTER (WHERE NOT EXISTS (SELECT 1 FROM src_role_permissions h
    WHERE h.role_title = s.higher_role AND h.data_domain = p.data_domain)) AS refused_to_higher
FROM (VALUES {_PAIRS}) AS s(chain, lower_role, higher_role)
LEFT JOIN log_requests q ON q.role_title = s.lower_role
LEFT JOIN src_role_permissions p ON p.role_title = q.role_title AND p.data_domain = q.data_domain
GROUP BY ALL""", tags=("access",))
def access_supersets(m):
    return superset_audit(m["src_role_permissions"], m["log_requests"], A.chain_pairs(m.spark))


@model("access_override", "ops", """SELECT q.data_domain, coalesce(p.access_scope, 'deny') AS access_scope,
  count(*) AS requests,
  count_if(p.access_scope = 'own_property' AND e.property_id <> q.claimed_property_id) AS overridden,
  count_if(p.access_scope = 'own_property' AND e.property_id IS NULL) AS unresolved, cast(0 AS bigint) AS leaked
FROM log_requests q
LEFT JOIN src_role_permissions p ON p.role_title = q.role_title AND p.data_domain = q.data_domain
LEFT JOIN employees e ON e.employee_id = q.employee_id GROUP BY 1, 2""", tags=("access",))
def access_override(m):
    return override_audit(m["src_role_permissions"], m["employees"], m["log_requests"])
