"""URL filter: given prefix rules, and association rules mined from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from gleaner.llm.tasks import stored
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host and path)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: Association rules need this share of the labelled rows and of the rows they fit.
MIN_SUPPORT = 0.001
#: and fit at least so many labelled rows to be blocked.
MIN_ROWS = 20
MIN_CONFIDENCE = 0.6
#: Labelled rows to learn from, drawn by a hash of the URL beyond that.
LABELLED_ROWS = 5_000_000
#: The rules are broadcast up to so many.
BROADCAST_RULES = 10_000

BLOCKED = "=block"
SEPARATOR = "://"


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return _lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: Sequence[tuple[str, str]], host_column: str = "host", path_column: str = "path") -> Column:
    """(verdict, rule) of the longest rule whose host is the URL's or a parent and whose path begins its path."""
    given = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in reversed(given):
        rule_host, slash, rest = rule.partition("/")
        own = (F.col(host_column) == rule_host) | F.col(host_column).endswith(f".{rule_host}")
        fits = own & F.col(path_column).startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def tokens(url: Column, host_column: Column, path_column: Column) -> Column:
    """Distinct tokens of a URL: labels of the host by level, words of the host, parts of the path, extension, keys."""
    labels = F.reverse(F.split(host_column, r"\."))
    hosts = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    words = F.transform(F.filter(F.split(host_column, r"[.-]"), lambda x: x != ""), lambda x: F.concat(F.lit("w:"), x))
    parts = F.filter(F.split(_lower_ascii(path_column), "/"), lambda x: x != "")
    parts = F.transform(parts, lambda x: F.concat(F.lit("p:"), x))
    extension = F.regexp_extract(path_column, r"\.([A-Za-z0-9]+)\z", 1)
    extension = F.when(extension != "", F.array(F.concat(F.lit("x:"), extension))).otherwise(F.array().cast("array<string>"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"\A([^=]*)", 1)), lambda x: x != "")
    keys = F.transform(keys, lambda x: F.concat(F.lit("q:"), x))
    return F.array_distinct(F.concat(words, hosts, parts, extension, keys))


def mined_tokens(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """The tokens of enough labelled rows and what they are mined as: (token, item).

    No combination with a rarer token has the support. Tokens of the very same
    rows are one item, so that combinations of these are not listed.
    """
    # Numbers of stored rows, fixed by their files.
    numbered = labelled.filter(F.size("tokens") > 0).select(F.monotonically_increasing_id().alias("row"), "tokens")
    rows = numbered.count()
    counted = numbered.select(F.xxhash64("row").alias("row"), F.explode("tokens").alias("token")).groupBy("token")
    mark = F.col("row").cast("decimal(20,0)")
    counted = counted.agg(F.count("*").alias("n"), F.sum(mark).alias("rows"), F.bit_xor("row").alias("mark"))
    counted = counted.filter((F.col("n") >= F.lit(min_support * rows)) & (F.col("n") >= MIN_ROWS))
    alike = counted.groupBy("n", "rows", "mark").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
    return stored(alike.select(F.explode("tokens").alias("token"), "item"), "mined-tokens")


def _items(sets: DataFrame, keep: list[str], items: DataFrame) -> DataFrame:
    """``keep`` and the items of the rows' tokens, for rows that have some."""
    exploded = sets.select(*keep, F.explode("tokens").alias("token"))
    return exploded.join(items, "token").groupBy(*keep).agg(F.collect_set("item").alias("items"))


def association_rules(
    labelled: DataFrame,
    items: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Item combinations that point to blocking: (needed, confidence, support) from (tokens, blocked).

    FP-growth finds the combinations in all ``items`` of each row; those of too little support or
    confidence go, and those with a shorter combination among them that is as
    confident.
    """
    numbered = labelled.filter(F.size("tokens") > 0).withColumn("row", F.monotonically_increasing_id())
    found = _items(numbered, ["row"], items)
    own = F.coalesce("items", F.array().cast("array<string>"))
    own = F.when(F.col("blocked"), F.array_append(own, F.lit(BLOCKED))).otherwise(own)
    baskets = stored(numbered.select("row", "blocked").join(found, "row", "left").select(own.alias("items")), "baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCKED)))
    rules = rules.filter(F.round(F.col("support") * baskets.count()) >= MIN_ROWS)
    rules = stored(
        rules.select(F.sort_array("antecedent").alias("needed"), "confidence", "support"), "association-rules"
    )
    shorter = rules.select(F.col("needed").alias("part"), F.col("confidence").alias("other"))
    indexed = shorter.withColumn("token", F.col("part")[0])
    covered = (
        rules.withColumn("token", F.explode("needed"))
        .join(indexed, "token")
        .filter(
            (F.size("part") < F.size("needed"))
            & (F.size(F.array_except("part", "needed")) == 0)
            & (F.col("other") >= F.col("confidence"))
        )
        .select("needed")
        .distinct()
    )
    return rules.join(covered, "needed", "left_anti")


def matched(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The confidence of the best association rule that fits: (tokens, confidence) for distinct token sets.

    A rule fits a URL that has a token of each item it needs.

    An inverted index has each rule under its token that the fewest rules
    need. The URLs' items fetch candidates there, of which those fit that
    need no other.
    """
    needed = rules.select("needed", "confidence", F.explode("needed").alias("token"))
    common = needed.groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", "token"))["token"].alias("token")
    index = needed.join(common, "token").groupBy("needed", "confidence").agg(rarest)
    index = stored(index, "rule-index")
    if index.count() <= BROADCAST_RULES:
        index = F.broadcast(index)
    sets = _items(urls.select("tokens").distinct(), ["tokens"], items)
    return (
        sets.select("tokens", "items", F.explode("items").alias("token"))
        .join(index, "token")
        .filter(F.size(F.array_except("needed", "items")) == 0)
        .groupBy("tokens")
        .agg(F.max("confidence").alias("confidence"))
    )


def judged(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_column: str = "page_id",
    url: str = "url",
    label_id: str = "doc_id",
    quality: str = "quality",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """The verdict on each URL: (id, host, path, rule, verdict, confidence).

    The longest given rule decides. Where none fits, a URL is blocked if a
    mined combination of its tokens does; else it is allowed. Labels are those
    of the rows with a page's id: quality 0 is to be blocked. ``confidence``
    is that of the best association rule, null if none fits.

    A null URL, or one without ``://``, has an empty host and path and no
    tokens, and is allowed. Repeated rows are judged alike, each with its own
    result row; without labels no association rule exists; an empty table
    gives an empty result; other columns do not matter.
    """
    named = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"))
    split = named.select("id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    with_tokens = F.when(F.col("host") != "", tokens(F.col("url"), F.col("host"), F.col("path")))
    none = F.array().cast("array<string>")
    parsed = split.select("id", "host", "path", F.coalesce(with_tokens, none).alias("tokens"))
    marks = labels.filter(F.col(quality).isNotNull()).groupBy(F.col(label_id).alias("id"))
    marks = marks.agg((F.min(quality) == 0).alias("blocked"))
    labelled = stored(parsed.join(marks, "id").select("id", "tokens", "blocked"), "labelled")
    known = labelled.count()
    if known > LABELLED_ROWS:
        drawn = F.pmod(F.xxhash64("id"), F.lit(known))
        labelled = labelled.filter(drawn < LABELLED_ROWS)
    items = mined_tokens(labelled, min_support)
    mined = association_rules(labelled, items, min_support, min_confidence)
    found = matched(parsed, mined, items)
    given = fitting_rule(rules)
    learnt = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return (
        parsed.withColumn("given", given)
        .join(found, "tokens", "left")
        .select(
            F.col("id").alias(id_column),
            "host",
            "path",
            F.col("given")["rule"].alias("rule"),
            F.coalesce(F.col("given")["verdict"], learnt).alias("verdict"),
            "confidence",
        )
    )
