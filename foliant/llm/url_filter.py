"""Host reputation by empirical Bayes, with explicit rules on top.

Labelled page outcomes are counted by host. Beta-binomial priors shrink each host towards its registered domain, the
domain towards its suffix and the suffix towards the whole table, each prior without its own child; the strength of each prior is estimated from the
spread between its children (method of moments). A host is blocked when the lower posterior bound of its rate of bad
pages exceeds a limit. Rules name a host and a path prefix; the longest that fits overrides the model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, stored, table

#: (verdict, host and path prefix); fixed by the query's contract.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Rules up to so many are compiled into one expression; more are joined as a table, with the same result.
COMPILED_RULES = 100
#: Block when mean - Z * sd of the posterior bad rate exceeds LIMIT. Prior strengths are kept within STRENGTH.
LIMIT, Z, STRENGTH = 0.30, 1.645, (1.0, 1_000.0)
#: Suffixes of two labels: the second-level ones of countries, and hosting services whose customers have a name each.
_SECOND = {
    "uk": "co org me ltd plc net ac gov sch nhs", "au": "com net org edu gov id asn", "nz": "co net org ac govt school", "jp": "co ne or ac go ad ed gr lg",
    "br": "com net org gov edu", "ar": "com net org gob edu", "mx": "com net org gob edu", "co": "com net org gov edu", "pe": "com net org gob edu", "ve": "com net org", "uy": "com net org", "ec": "com net org",
    "za": "co net org ac gov web", "ke": "co or ac go", "ng": "com net org gov edu", "gh": "com org edu gov", "eg": "com net org gov edu",
    "in": "co net org ac gov edu res", "pk": "com net org gov edu", "bd": "com net org gov edu", "lk": "com org gov ac", "cn": "com net org gov edu ac", "hk": "com net org gov edu", "tw": "com net org gov edu",
    "kr": "co ne or ac go re", "sg": "com net org gov edu", "my": "com net org gov edu", "th": "co or ac go in", "id": "co or ac go web", "ph": "com net org gov edu", "vn": "com net org gov edu",
    "tr": "com net org gov edu", "il": "co net org ac gov", "sa": "com net org gov edu", "ae": "co net org ac gov", "ua": "com net org gov edu", "pl": "com net org gov edu", "gr": "com net org gov edu", "pt": "com org gov edu", "es": "com org gob edu", "cy": "com org ac gov", "hu": "co", "at": "co or ac gv",
    "io": "github gitlab", "com": "blogspot wordpress herokuapp weebly wixsite", "dev": "pages workers web", "app": "netlify vercel web", "net": "azurewebsites cloudfront", "me": "medium",
}
SUFFIXES = tuple(f"{x}.{last}" for last, xs in _SECOND.items() for x in xs.split())
#: Suffixes up to so many are part of one expression; more are joined as a table, with the same result.
COMPILED_SUFFIXES = 500
#: Host verdict rows that may be broadcast; beyond it the join shuffles.
BROADCAST_HOSTS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str = "url") -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits columns host and path; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for does, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, slash, path = rule.partition("/")
        fits = ((F.col("host") == at) | F.col("host").endswith("." + at)) & F.col("path").startswith(slash + path)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(does)).otherwise(verdict)
    return name, verdict


def with_rules(urls: DataFrame, rules) -> DataFrame:
    """urls (host, path, ...) with rule and rule_verdict. rules: pairs of verdict and host with path prefix, or a table (verdict, rule).

    A table of rules meets the different (host, path) by an equal join: on the host and each domain above it, and the
    start of the path up to each length that the rules of that domain have.
    """
    if not isinstance(rules, DataFrame):
        if len(rules) <= COMPILED_RULES:
            rule, verdict = rule_of(rules)
            return urls.withColumns({"rule": rule, "rule_verdict": verdict})
        rules = urls.sparkSession.createDataFrame(list(rules), "verdict string, rule string")
    at = F.substring_index("rule", "/", 1)
    r = rules.where("rule is not null").select(at.alias("r_host"), F.expr("substr(rule, length(substring_index(rule, '/', 1)) + 1)").alias("r_path"), "rule", "verdict")
    lengths = r.groupBy("r_host").agg(F.array_sort(F.collect_set(F.length("r_path"))).alias("lengths")).withColumnRenamed("r_host", "above")
    each = urls.select("host", "path").distinct()
    parts = F.split("host", r"\.", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    x = each.select("host", "path", F.explode(above).alias("above")).join(small(lengths, BROADCAST_HOSTS), "above")
    x = x.select("host", "path", "above", F.explode("lengths").alias("n")).where(F.length("path") >= F.col("n"))
    x = x.join(r, (F.col("above") == F.col("r_host")) & (F.expr("substr(path, 1, n)") == F.col("r_path")))
    best = x.groupBy("host", "path").agg(F.max(F.struct(F.length("rule"), "rule", "verdict")).alias("best"))
    best = best.select("host", "path", "best.rule", F.col("best.verdict").alias("rule_verdict"))
    return urls.join(best, ["host", "path"], "left")


def _bare(host: str) -> Column:
    """A host without user info, port and final dot."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":\d*$", ""), r"\.$", "")


def with_sites(hosts: DataFrame, suffixes: tuple[str, ...] | DataFrame = SUFFIXES) -> DataFrame:
    """hosts (host, ...) with domain (the registered one) and suffix. suffixes: names of one label or more, or a table (suffix) of them.

    The suffix is the longest of `suffixes` that the host ends with, label by label, else its last label; the domain has one label more. An
    IP address is a domain of its own, and all of them have one suffix. A table of suffixes meets the hosts by an equal join on
    each domain above them; a tuple of up to COMPILED_SUFFIXES is part of the expression.
    """
    x = hosts.withColumn("_name", _bare("host"))
    parts = F.split("_name", r"\.", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("k"), F.array_join(F.slice(parts, F.size(parts) - i + 1, i), ".").alias("above")))
    if not isinstance(suffixes, DataFrame) and len(suffixes) > COMPILED_SUFFIXES:
        suffixes = hosts.sparkSession.createDataFrame([(s,) for s in suffixes], "suffix string")
    if isinstance(suffixes, DataFrame):
        each = x.select("host", F.explode(above).alias("a")).select("host", "a.k", F.col("a.above").alias("suffix"))
        known = each.join(small(suffixes.select("suffix").distinct(), BROADCAST_HOSTS), "suffix").groupBy(F.col("host").alias("_host")).agg(F.max("k").alias("_k"))
        x = x.join(known, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    else:
        x = x.withColumn("_k", F.array_max(F.transform(F.filter(above, lambda a: a["above"].isin(*suffixes)), lambda a: a["k"])) if suffixes else F.lit(None).cast("int"))
    x = x.withColumn("_k", F.coalesce("_k", F.lit(1)))
    ip = F.col("_name").rlike(r"^\d{1,3}(\.\d{1,3}){3}$") | F.col("_name").startswith("[")
    domain, suffix = (F.expr(f"substring_index(_name, '.', -(_k + {n}))") for n in (1, 0))
    return x.withColumns({"domain": F.when(ip, F.col("_name")).otherwise(domain), "suffix": F.when(ip, "[ip]").otherwise(suffix)}).drop("_name", "_k")


def _strength(level: DataFrame) -> float:
    """How many pseudo-outcomes the parent is worth, from children with columns n and bad."""
    m = level.where("n > 0").agg(F.sum("n").alias("N"), F.sum("bad").alias("B"), F.count("*").alias("g"), F.sum(F.lit(1.0) / F.col("n")).alias("inv"), F.sum(F.col("bad") / F.col("n")).alias("s1"), F.sum((F.col("bad") / F.col("n")) * (F.col("bad") / F.col("n"))).alias("s2"))
    mean = F.col("B") / F.col("N")
    spread = F.col("s2") / F.col("g") - (F.col("s1") / F.col("g")) * (F.col("s1") / F.col("g"))
    noise = mean * (1 - mean) * F.col("inv") / F.col("g")
    k = F.when(spread > noise, (mean * (1 - mean) - spread) / F.nullif(spread - noise, F.lit(0.0))).otherwise(F.lit(STRENGTH[1]))
    k = F.least(F.greatest(F.when(F.col("N") > 0, k), F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))
    return m.select(F.round(F.coalesce(k, F.lit(STRENGTH[1])), 2).alias("k")).first()["k"]


def reputations(outcomes: DataFrame, limit: float = LIMIT, z: float = Z, suffixes: tuple[str, ...] | DataFrame = SUFFIXES) -> DataFrame:
    """outcomes: host, n, bad (one row per host, n may be 0). Returns host and blocked.

    Domain and suffix are those of `with_sites`.
    """
    hosts = with_sites(outcomes, suffixes)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    m0 = (whole["bad"] + 0.5) / (whole["n"] + 1.0)
    k0, k1, k2 = (F.lit(_strength(x)) for x in (suffixes, domains, hosts))
    # each level's prior leaves out the outcomes of the child that it is for: they count once
    suffixes = suffixes.select("suffix", F.col("n").alias("n_s"), F.col("bad").alias("bad_s"))
    domains = domains.join(suffixes, "suffix")
    m1 = (F.col("bad_s") - F.col("bad") + k0 * F.lit(m0)) / (F.col("n_s") - F.col("n") + k0)
    domains = domains.select("domain", F.col("n").alias("n_d"), F.col("bad").alias("bad_d"), m1.alias("m1"))
    m2 = (F.col("bad_d") - F.col("bad") + k1 * F.col("m1")) / (F.col("n_d") - F.col("n") + k1)
    hosts = hosts.join(domains, "domain").withColumn("m2", m2)
    hosts = hosts.withColumn("m3", (F.col("bad") + k2 * F.col("m2")) / (F.col("n") + k2))
    sd = F.sqrt(F.col("m3") * (1 - F.col("m3")) / (F.col("n") + k2 + 1))
    return hosts.select("host", (F.col("m3") - z * sd > limit).alias("blocked"))


def url_filter(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = LIMIT, z: float = Z, suffixes: tuple[str, ...] | DataFrame = SUFFIXES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    labels (doc_id, quality, toxic) are outcomes of the page with the same id; bad is quality 0 or toxic 1, a label
    with both null is no outcome. rules are those of `with_rules`, suffixes those of `with_sites`. A null url, or one without "://", has an empty host and path. Repeated pages and
    repeated labels count each time. Empty tables give empty results or verdicts from the prior alone.
    """
    seen = stored(pages.select("page_id", host_of().alias("host"), path_of().alias("path")), "urls")
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    label = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    label = label.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(bad.cast("long")).alias("bad"))
    outcome = seen.join(label, seen.page_id == label.doc_id, "left").groupBy("host")
    outcome = outcome.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    judged = stored(reputations(stored(outcome, "hosts"), limit, z, suffixes), "reputations")
    out = with_rules(seen, rules).join(small(judged, BROADCAST_HOSTS), "host", "left")
    model = F.when(F.col("blocked"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", model).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


_STRENGTH_SQL = """SELECT coalesce(round(CASE WHEN N > 0 THEN least(greatest(CASE WHEN s2/g - (s1/g)*(s1/g) > (B/N)*(1-B/N)*inv/g
  THEN ((B/N)*(1-B/N) - (s2/g - (s1/g)*(s1/g))) / nullif(s2/g - (s1/g)*(s1/g) - (B/N)*(1-B/N)*inv/g, 0) ELSE 1000.0 END, 1.0), 1000.0) ELSE 1000.0 END, 2), 1000.0) AS k
  FROM (SELECT sum(n)::double AS N, sum(bad)::double AS B, count(*)::double AS g, sum(1.0::double / n) AS inv, sum(bad::double / n) AS s1, sum((bad::double / n) * (bad::double / n)) AS s2 FROM {0} WHERE n > 0)"""

ORACLE = (
    r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT doc_id, count(*) AS n, sum((coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::bigint) AS bad
      FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
h3 AS (SELECT host, coalesce(sum(n), 0)::bigint AS n, coalesce(sum(bad), 0)::bigint AS bad, regexp_replace(regexp_replace(regexp_replace(host, '^(?s:.*)@', ''), ':[0-9]*$', ''), '\.$', '') AS name
      FROM u LEFT JOIN l ON u.page_id = l.doc_id GROUP BY host),
h2 AS (SELECT *, string_split(name, '.') AS p, coalesce(list_max(list_filter(range(1, len(string_split(name, '.')) + 1), lambda i: list_contains([{SUFFIXES}], array_to_string(string_split(name, '.')[-i:], '.')))), 1) AS k,
             regexp_matches(name, '^[0-9]{1,3}(\.[0-9]{1,3}){3}$') OR starts_with(name, '[') AS ip FROM h3),
h AS (SELECT host, n, bad, CASE WHEN ip THEN '[ip]' ELSE array_to_string(p[-k:], '.') END AS suffix, CASE WHEN ip THEN name ELSE array_to_string(p[-(k + 1):], '.') END AS domain FROM h2),
d AS (SELECT domain, suffix, sum(n)::bigint AS n, sum(bad)::bigint AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n)::bigint AS n, sum(bad)::bigint AS bad FROM d GROUP BY ALL),
w AS (SELECT coalesce((sum(bad) + 0.5::double) / (sum(n) + 1.0::double), 0.5) AS m0 FROM s),
k0 AS ("""
    + _STRENGTH_SQL.format("s")
    + "),\nk1 AS ("
    + _STRENGTH_SQL.format("d")
    + "),\nk2 AS ("
    + _STRENGTH_SQL.format("h")
    + r"""),
d1 AS (SELECT d.domain, d.n AS n_d, d.bad AS bad_d, (s.bad - d.bad + k0.k * m0) / (s.n - d.n + k0.k) AS m1 FROM d JOIN s USING (suffix), w, k0),
h0 AS (SELECT host, h.n, h.bad, (bad_d - h.bad + k1.k * m1) / (n_d - h.n + k1.k) AS m2 FROM h JOIN d1 USING (domain), k1),
h1 AS (SELECT host, n, k2.k AS k, (bad + k2.k * m2) / (n + k2.k) AS m3 FROM h0, k2),
r(verdict, rule, base, path) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
f AS (SELECT x.host, x.path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM (SELECT DISTINCT host, path FROM u) x JOIN r ON (x.host = r.base OR ends_with(x.host, '.' || r.base)) AND starts_with(x.path, r.path)
      GROUP BY ALL)
SELECT u.page_id, u.host, u.path, f.rule,
       coalesce(f.verdict, CASE WHEN m3 - 1.645 * sqrt(m3 * (1 - m3) / (n + k + 1)) > 0.30 THEN 'block' ELSE 'allow' END) AS verdict
FROM u JOIN h1 USING (host) LEFT JOIN f ON u.host = f.host AND u.path = f.path
"""
).replace("{SUFFIXES}", ", ".join(f"'{s}'" for s in SUFFIXES))
