"""URL filters: explicit rules first, and mined association rules for the rest.

Explicit rules name a host (with its subdomains) and a path prefix; the longest
that fits judges. The pages that a rule judges are the labelled examples: their
URL tokens (host labels, path segments, query keys, scheme) with the verdict as
one more item are the transactions of FP-growth. What it finds to imply a verdict
is counted anew over all labelled pages and stays with enough support, confidence
and lift over the verdict's own share, unless a part of it says the same with no
less confidence. These rules judge the pages that no explicit rule fits; each
stands in an inverted index under its rarest token.

A rule of several tokens stays only if each of them takes away counterexamples and
none has no counterexample, so only such tokens are combined. Itemsets double with each token
that pages share: FP-growth gets the pages of at most ``MOST_TOKENS`` of these tokens, and
what pages of more hold is grown token by token, in the pages that hold what was grown so
far, as long as each token takes away counterexamples. That is complete: no
combination is left out, however long; its work follows the number of such combinations.

Pages are judged by their distinct token sets, so a host with a third of all
pages is judged once for each form of its URLs; then verdicts are joined back.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import ascii_lower, fresh, replacing, stored
from sieveline.operators.joins import redealt

SUPPORT, CONFIDENCE, LIFT = 0.01, 0.6, 1.1
#: Tokens of a transaction of FP-growth; what longer ones hold is grown level by level.
MOST_TOKENS = 8
#: Up to so many rules are one expression; more are joined by host.
INLINE = 200
DEFAULT = "allow"

RULES = "antecedent array<string>, verdict string, confidence double, support double, lift double, key string"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens, sorted; digits of path segments are one sign, so that pages of
    one form have one token set."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    words = lambda text, by: F.filter(F.split(text, by), lambda x: x != "")
    named = lambda kind, parts: F.transform(parts, lambda x: F.concat(F.lit(kind), x))
    segments = F.transform(words(path, "/"), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    keys = F.transform(words(query, "&"), lambda x: F.substring_index(x, "=", 1))
    scheme = F.array(F.concat(F.lit("s:"), F.substring_index(url, "://", 1)))
    parts = F.concat(named("h:", words(host, r"\.")), named("p:", segments), named("q:", keys), F.when(host != "", scheme).otherwise(F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.coalesce(parts, F.array().cast("array<string>"))))


def _fits(host: Column, path: Column, rule_host: Column, rule_path: Column) -> Column:
    return ((host == rule_host) | F.endswith(host, F.concat(F.lit("."), rule_host))) & F.startswith(path, rule_path)


def judged_by_rules(sites: DataFrame, rules: list[tuple[str, str, str]], host: str = "host", path: str = "path", rule: str = "rule", verdict: str = "verdict") -> DataFrame:
    """``sites`` (columns host and path) with rule and verdict: those of the longest
    fitting rule (host, path, verdict), ties to the greater text; else null."""
    if not rules:
        return sites.withColumns({rule: F.lit(None).cast("string"), verdict: F.lit(None).cast("string")})
    (best,) = fresh([*sites.columns, rule, verdict], "__best")
    if len(rules) <= INLINE:
        options = [F.when(_fits(F.col(host), F.col(path), F.lit(h), F.lit(p)), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in rules]
        found = sites.withColumn(best, F.array_max(F.array(*options)))
    else:
        known = sites.sparkSession.createDataFrame(rules, "rule_host string, rule_path string, verdict string")
        labels = F.split("host", r"\.")
        suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        text = F.concat("rule_host", "rule_path")
        longest = (
            sites.select(F.col(host).alias("host"), F.col(path).alias("path"))
            .distinct()
            .select("host", "path", F.explode(suffixes).alias("rule_host"))
            .join(known, "rule_host")
            .where(F.startswith("path", F.col("rule_path")))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length(text), text.alias("rule"), "verdict")).alias("best"))
        )
        found = sites.join(longest.toDF(host, path, best), [host, path], "left")
    return found.withColumns({rule: F.col(f"{best}.rule"), verdict: F.col(f"{best}.verdict")}).drop(best)


def shape(tokens: Column) -> list[Column]:
    """128 bits that name a token set: h1 and h2."""
    return [F.xxhash64(tokens).alias("h1"), F.xxhash64(F.lit(1), tokens).alias("h2")]


def fitting(shapes: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules whose antecedent a shape (h1, h2, tokens) holds: h1, h2 and the rules' columns.

    A shape's tokens are first reduced to those that rules name, one token a row, so
    that a URL of many tokens isn't carried along with each of them."""
    named = rules.select(F.explode("antecedent").alias("item")).distinct()
    known = shapes.select("h1", "h2", F.explode("tokens").alias("item")).join(named, "item").groupBy("h1", "h2").agg(F.collect_set("item").alias("known"))
    met = known.select("h1", "h2", "known", F.explode("known").alias("key")).join(rules, "key")
    return met.where(F.size(F.array_except("antecedent", "known")) == 0).drop("known")


def grown(long: DataFrame, least: float) -> DataFrame:
    """antecedent: the token sets of two and more within a row marked ``long`` that rows of the
    verdict hold at least ``least`` times, each of whose tokens takes away counterexamples.

    long: said, items (sorted), pos and neg (how many rows of this verdict and of others have
    these items) and long. Both conditions hold for all parts of a set for which they hold,
    so a level's sets are made from the last one's."""
    spark = long.sparkSession
    held = long.select("said", "pos", "neg", "long", F.posexplode("items").alias("at", "item"), "items")
    held = held.select("said", F.array("item").alias("set"), "pos", "neg", "long", F.slice("items", F.col("at") + 2, F.size("items")).alias("rest"))
    known = stored(held.groupBy("said", "set").agg(F.sum("neg").alias("neg")), "level")
    levels, size = [spark.createDataFrame([], "antecedent array<string>")], 1
    while True:
        size += 1
        wider = held.select("said", "set", "pos", "neg", "long", "rest", F.posexplode("rest").alias("at", "item"))
        wider = wider.select("said", F.concat("set", F.array("item")).alias("set"), "pos", "neg", "long", F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"))
        counts = wider.groupBy("said", "set").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("long").alias("long")).where((F.col("pos") >= least) & F.col("long"))
        parts = counts.select("said", F.col("set").alias("whole"), F.col("neg").alias("left"), F.explode("set").alias("item"), "set")
        parts = parts.select("said", "whole", "left", F.filter("set", lambda x: x != F.col("item")).alias("set")).join(known, ["said", "set"]).where("neg > left")
        level = stored(parts.groupBy("said", "whole").agg(F.count("*").alias("n"), F.first("left").alias("neg")).where(F.col("n") == size).select("said", F.col("whole").alias("set"), "neg"), "level")
        if level.isEmpty():
            break
        levels.append(level.select(F.col("set").alias("antecedent")))
        known = level.where("neg > 0")
        held = stored(wider.join(known.select("said", "set"), ["said", "set"], "left_semi"), "held")
    for more in levels[1:]:
        levels[0] = levels[0].unionByName(more)
    return levels[0]


def mine(labelled: DataFrame, *, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """labelled: tokens, verdict. antecedent, verdict, confidence, support, lift and key (the
    antecedent's rarest item, ties to the lesser) of each rule, counted over all rows.

    Empty without rows. Rows without tokens count for the verdicts' shares.
    """
    spark = labelled.sparkSession
    rows = stored(labelled.select(*shape(F.col("tokens")), "tokens", "verdict"), "labelled")
    shares = {r["verdict"]: r["n"] for r in rows.groupBy("verdict").agg(F.count("*").alias("n")).collect()}  # a few verdicts
    total = sum(shares.values())
    if not total:
        return spark.createDataFrame([], RULES)
    share = F.element_at(F.create_map(*[F.lit(x) for v, n in shares.items() for x in (v, n / total)]), F.col("verdict"))
    shapes = stored(rows.groupBy("h1", "h2", "verdict").agg(F.count("*").alias("n"), F.first("tokens").alias("tokens")), "shapes")

    least = support * total * (1 - 1e-9)  # what is proposed is counted anew
    by_item = stored(shapes.select(F.explode("tokens").alias("item"), "verdict", "n").groupBy("item", "verdict").agg(F.sum("n").alias("n")), "by-item")
    frequent = stored(by_item.groupBy("item").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least), "items")
    proposed = frequent.select(F.array("item").alias("antecedent"))
    # a token joins others for a verdict if some, but not all, of the other verdicts' rows have it
    others = F.col("freq") - F.col("n")
    mixed = by_item.join(frequent, "item").where((F.col("n") >= least) & (others > 0) & (others < total * (1 - share) - 0.5))
    mixed = stored(mixed.select("item", F.col("verdict").alias("said")), "mixed")
    sets = shapes.select("h1", "h2", "verdict", "n", F.explode("tokens").alias("item")).join(mixed, "item").groupBy("h1", "h2", "verdict", "said").agg(F.array_sort(F.collect_list("item")).alias("items"), F.first("n").alias("n"))
    own = F.col("verdict") == F.col("said")
    sets = sets.groupBy("said", "items").agg(F.sum(F.when(own, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(own, 0).otherwise(F.col("n"))).alias("neg"))
    sets = stored(sets.withColumn("long", (F.size("items") > most_tokens) & (F.col("pos") > 0)), "item-sets")
    short = sets.where((F.col("pos") > 0) & (F.size("items") <= most_tokens)).select(F.concat("items", F.array(F.concat(F.lit("="), "said"))).alias("items"), F.explode(F.sequence(F.lit(1), "pos")))
    transactions = stored(redealt(short.select("items")), "transactions")
    of_short = transactions.count()
    if of_short and of_short >= least:
        model = FPGrowth(itemsCol="items", minSupport=least / of_short, minConfidence=confidence).fit(transactions)
        found = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit("=")) & ~F.exists("antecedent", lambda x: F.startswith(x, F.lit("="))))
        proposed = proposed.unionByName(found.select(F.array_sort("antecedent").alias("antecedent")))
    if not sets.where("long").isEmpty():
        proposed = proposed.unionByName(grown(sets, least))
    proposed = proposed.distinct()
    keyed = proposed.select("antecedent", F.explode("antecedent").alias("item")).join(frequent, "item").groupBy("antecedent").agg(F.min(F.struct("freq", "item")).alias("rarest"))
    keyed = stored(keyed.select("antecedent", F.col("rarest.item").alias("key")), "proposed")

    held = fitting(shapes.select("h1", "h2", "tokens").dropDuplicates(["h1", "h2"]), keyed).join(shapes.select("h1", "h2", "verdict", "n"), ["h1", "h2"])
    counted = held.groupBy("antecedent", "key", "verdict").agg(F.sum("n").alias("n"))
    of_all = counted.groupBy("antecedent").agg(F.sum("n").alias("freq"))
    rules = counted.join(of_all, "antecedent").select("antecedent", "verdict", (F.col("n") / F.col("freq")).alias("confidence"), (F.col("n") / total).alias("support"), (F.col("n") / F.col("freq") / share).alias("lift"), "key")
    rules = stored(rules.where((F.col("support") >= support) & (F.col("confidence") >= confidence) & (F.col("lift") >= lift)), "rules")
    # a rule adds nothing where a part of its antecedent says the same with no less confidence
    parts = rules.select(F.col("antecedent").alias("part"), "antecedent", "verdict", F.col("confidence").alias("part_confidence"), "key").withColumnRenamed("verdict", "said")
    whole = rules.select("antecedent", "verdict", "confidence", *shape(F.col("antecedent")))
    implied = fitting(whole.select("h1", "h2", F.col("antecedent").alias("tokens")).distinct(), parts).select("h1", "h2", "part", "said", "part_confidence")
    idle = whole.join(implied, ["h1", "h2"]).where((F.size("part") < F.size("antecedent")) & (F.col("said") == F.col("verdict")) & (F.col("part_confidence") >= F.col("confidence")))
    return stored(rules.join(idle.select("antecedent", "verdict").distinct(), ["antecedent", "verdict"], "left_anti"), "mined").select("antecedent", "verdict", "confidence", "support", "lift", "key")


def judged_by_mined(shapes: DataFrame, mined: DataFrame) -> DataFrame:
    """h1, h2 and mined: the verdict of the fitting mined rule of the most confidence,
    then the longest, then of the most support, then the least in order."""
    order = F.struct(-F.col("confidence"), -F.size("antecedent"), -F.col("support"), F.col("antecedent"), F.col("verdict").alias("verdict"))
    return fitting(shapes, mined).groupBy("h1", "h2").agg(F.min(order).alias("best")).select("h1", "h2", F.col("best.verdict").alias("mined"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], *, url_col: str = "url", **options) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``options`` are those of ``mine``.

    rules: (host, path prefix, verdict). A null url or one without ``://`` has an
    empty host and path, which no rule fits. A page that neither an explicit nor a
    mined rule fits is allowed. Without labelled pages nothing is mined. Repeated
    rows stay; an empty table gives no rows. All input columns stay, but for those
    named like an output.
    """
    url = F.col(f"`{url_col}`").cast("string")
    inner = ["host", "path", "rule", "verdict", "tokens", "h1", "h2", "v1", "v2", "mined"]
    own = dict(zip(inner, fresh(pages.columns, *[f"__{c}" for c in inner]), strict=True))
    read = pages.withColumns({own["host"]: url_host(url), own["path"]: url_path(url)})
    read = judged_by_rules(read, rules, *[own[c] for c in inner[:4]]).withColumn(own["tokens"], url_tokens(url, F.col(own["host"]), F.col(own["path"])))
    judged, tokens = F.col(own["verdict"]), F.col(own["tokens"])
    mined = mine(read.where(judged.isNotNull()).select(tokens.alias("tokens"), judged.alias("verdict")), **options)
    shapes = read.where(judged.isNull()).select(*shape(tokens), tokens.alias("tokens")).dropDuplicates(["h1", "h2"])
    verdicts = stored(judged_by_mined(shapes, mined), "verdicts").toDF(own["v1"], own["v2"], own["mined"])
    named = read.withColumns({own[h]: c for h, c in zip(("h1", "h2"), shape(tokens), strict=True)})
    joined = named.join(verdicts, (F.col(own["h1"]) == F.col(own["v1"])) & (F.col(own["h2"]) == F.col(own["v2"])) & judged.isNull(), "left")
    result = replacing(joined, host=F.col(own["host"]), path=F.col(own["path"]), rule=F.col(own["rule"]), verdict=F.coalesce(judged, own["mined"], F.lit(DEFAULT)))
    return result.drop(*own.values())
