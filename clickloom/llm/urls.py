"""URL filter: rules by host and path, and a character language-model ratio for the URLs that no rule fits.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, say how likely each character is behind the longest seen
context of up to three before it. A context of length k is interpolated with that of length k - 1 by the number of its distinct successors
(Witten-Bell), down to the uniform distribution, so each model sums to one; a context that was never seen leaves the word to the shorter one. The mean over a URL of the logarithm of their ratio is its
score; it is allowed from a threshold on, which is calibrated on labelled URLs that the models have not seen: the one with the best
mean of both classes' shares of right answers.

Characters are 32 symbols (end, the letters without case, digit, slash, dot, other ASCII, everything else), so there are at most 33,825
contexts however large the table is. Counting takes one aggregation with at most 32**4 groups; the models come as one array of 32**4 ratios,
4 MB at any size of the table, in a scalar subquery. Scoring looks up one number a character and
shuffles nothing: no key is grouped, so a host or URL that a third of all rows share is no hot key. Ratios are whole numbers of 2**-16,
so sums don't depend on any order. DataFrame functions only; nothing runs before the result is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS, ORDER = 32, 3  # symbols of the alphabet, longest context
SCALE = 65536
BIN = 256  # scores are compared in steps of BIN / SCALE
OFFSETS = [sum(SYMBOLS**j for j in range(k)) for k in range(ORDER + 1)]  # where the contexts of a length begin
SLOTS = sum(SYMBOLS**j for j in range(ORDER + 1))


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


# Those of the registered query.
RULES = (
    Rule("net", "/", False), Rule("example.net", "/en/", True), Rule("example.com", "/de/", False), Rule("org", "/fr/", True))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z in lower case, and the path; both empty without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda group: F.coalesce(F.regexp_extract(url, shape, group), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct<name, allow> of the longest rule that fits, else null; of equally long ones that with the longer host, then by name."""
    found = F.lit(None).cast("struct<name:string,allow:boolean>")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        named = rule.host.lower()
        fits = ((host == named) | host.endswith("." + named)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.allow).alias("allow"))).otherwise(found)
    return found


def _symbol_of(code: int) -> int:
    char = chr(code)
    if char.lower() in LOWER:
        return LOWER.index(char.lower()) + 1
    return 27 if char.isdigit() else {"/": 28, ".": 29}.get(char, 30)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _upto(count: int) -> Column:
    return F.sequence(F.lit(0), F.lit(count - 1))


def grams(url: Column) -> Column:
    """Numbers of a context of three symbols and the symbol behind it, one for each character and one for the end."""
    ascii_symbols = F.array(*[F.lit(_symbol_of(code)) for code in range(128)])
    chars = F.filter(F.split(url, ""), lambda c: c != "")
    known = F.transform(chars, lambda c: F.coalesce(F.get(ascii_symbols, F.ascii(c)), F.lit(31)))
    padded = F.concat(F.array(*[F.lit(0)] * ORDER), known, F.array(F.lit(0)))

    def cut(symbols: Column) -> Column:
        at = lambda i: F.get(symbols, i)
        gram = lambda i: ((at(i) * SYMBOLS + at(i + 1)) * SYMBOLS + at(i + 2)) * SYMBOLS + at(i + 3)
        return F.transform(F.sequence(F.lit(0), F.size(symbols) - (ORDER + 1)), gram)

    return _let(padded, cut)


def _level(counts: DataFrame, length: int, lower: DataFrame | None) -> DataFrame:
    """(context, symbol, accepted, rejected): both models' probabilities behind each seen context of one length."""
    seen = counts.groupBy(
        (F.shiftright(F.col("gram"), 5) % SYMBOLS**length).alias("context"), (F.col("gram") % SYMBOLS).alias("symbol"),
    ).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    cells = seen.groupBy("context").agg(
        F.sum("a").alias("all_a"), F.sum("r").alias("all_r"),
        F.count_if(F.col("a") > 0).alias("kinds_a"), F.count_if(F.col("r") > 0).alias("kinds_r"),
        F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("a", "r")))).alias("counts"))
    cells = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(SYMBOLS - 1))).alias("symbol"))
    cells = cells.withColumn("count", F.col("counts")[F.col("symbol")]).drop("counts")
    if lower is None:  # both classes must have been seen at all
        cells = cells.where("all_a > 0 and all_r > 0")
        low = {kind: F.lit(1 / SYMBOLS) for kind in ("a", "r")}
    else:
        below = lower.select(F.col("context").alias("_short"), "symbol", F.struct("accepted", "rejected").alias("_low"))
        cells = cells.withColumn("_short", F.col("context") % SYMBOLS ** (length - 1)).join(below, ["_short", "symbol"])
        low = {"a": F.col("_low.accepted"), "r": F.col("_low.rejected")}

    def chance(kind: str) -> Column:
        kinds, total, count = F.col(f"kinds_{kind}"), F.col(f"all_{kind}"), F.coalesce(F.col(f"count.{kind}"), F.lit(0))
        # A context that one of the classes never has tells nothing of that class beyond the shorter one.
        return F.when(total > 0, (count + kinds * low[kind]) / (total + kinds)).otherwise(low[kind])

    return cells.select("context", "symbol", chance("a").alias("accepted"), chance("r").alias("rejected"))


def fit(labelled: DataFrame) -> DataFrame:
    """One row (model): the log ratio of each of the 32**4 grams, taken behind the longest context that was seen.

    ``labelled`` has url and accepted. All of its rows count; without rows of both kinds the model is null.
    """
    found = labelled.select(F.explode(grams(F.col("url"))).alias("gram"), "accepted")
    counts = found.groupBy("gram").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    ratio = F.floor((F.ln("accepted") - F.ln("rejected")) * SCALE + 0.5).cast("int")
    cells, level = [], None
    for length in range(ORDER + 1):
        level = _level(counts, length, level)
        slot = (F.col("context") + OFFSETS[length]).alias("slot")
        cells.append(level.select(slot, F.struct("symbol", ratio.alias("ratio")).alias("cell")))
    rows = reduce(DataFrame.union, cells).groupBy("slot").agg(F.sort_array(F.collect_list("cell"))["ratio"].alias("ratios"))
    slots = labelled.sparkSession.range(0, SLOTS, 1, 1).join(rows, F.col("id") == F.col("slot"), "left")
    seen = slots.agg(F.sort_array(F.collect_list(F.struct("id", "ratios")))["ratios"].alias("seen"))

    def longest(context: Column) -> Column:
        return F.coalesce(*[F.get("seen", context % SYMBOLS**k + OFFSETS[k]) for k in range(ORDER, -1, -1)])

    return seen.select(F.flatten(F.transform(_upto(SYMBOLS**ORDER), longest)).alias("model"))


def _scored(rows: DataFrame, model: Column, name: str) -> DataFrame:
    """``rows`` with the mean log ratio of their URL in whole steps; null without a model.

    The model is named in one place, so the optimizer puts the subquery there and no row carries it.
    """
    total = lambda found: F.aggregate(
        found, F.lit(0).cast("long"), lambda done, gram: done + F.get(F.col("_model"), gram))
    step = _let(grams(F.col("url")), lambda found: F.floor(total(found) / (F.size(found) * F.lit(BIN))))
    return rows.withColumn("_model", model).withColumn(name, step.cast("long")).drop("_model")


def calibrate(scored: DataFrame) -> DataFrame:
    """One row (threshold): the step from which URLs are allowed; null unless both classes occur.

    ``scored`` has accepted and step. The classes weigh the same; of equally good cuts the lowest is taken, and the threshold lies midway
    between the steps on its two sides. There are as many groups
    as steps, a few thousand at most, whatever the number of rows.
    """
    steps = scored.where("step is not null").groupBy("step").agg(
        F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    everything = Window.partitionBy()
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: c.cast("decimal(19,0)")
    figures = steps.select(
        "step", F.sum("a").over(everything).alias("all_a"), F.sum("r").over(everything).alias("all_r"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("a_below"),
        F.coalesce(F.sum("r").over(below), F.lit(0)).alias("r_below"), F.max("step").over(below).alias("last"))
    right = wide(F.col("all_a") - F.col("a_below")) * wide(F.col("all_r")) + wide(F.col("r_below")) * wide(F.col("all_a"))
    middle = F.ceil((F.coalesce("last", "step") + F.col("step")) / 2)
    return figures.where("all_a > 0 and all_r > 0").agg(F.max_by(middle, F.struct(right, -F.col("step"))).alias("threshold"))


def filter_urls(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: Sequence[Rule] = RULES, held_parts: int = 5,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, log_ratio) for every row; the verdict is ``allow`` or ``block``.

    The longest rule that fits decides. URLs with a rule are the labelled ones: the models are fitted on all but one of ``held_parts`` parts
    of them by the URL's hash, and calibrated on that one. Every other URL is judged by them. Where labelled URLs of both kinds are missing in one of the
    two parts, nothing is blocked but by rules. A null url is empty, has no host or path and is judged as the empty string; an empty path
    starts with no rule's path but an empty one. Repeated rows and ids are judged row by row, null ids too. An empty table gives no
    rows. Other columns are dropped. ``log_ratio`` is the score in nats, rounded down to 1/256; null without a model.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("_rule", first_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.where("_rule is not null").select("url", F.col("_rule.allow").alias("accepted"))
    held = F.conv(F.substring(F.sha2(F.encode("url", "UTF-8"), 256), 1, 8), 16, 10).cast("long") % held_parts == 0
    model = fit(labelled.where(~held)).scalar()
    known = _scored(labelled.where(held), model, "step")
    threshold = calibrate(known).scalar()
    judged = _scored(rows, model, "_step")
    allowed = F.coalesce(F.col("_rule.allow"), F.col("_step") >= threshold, F.lit(True))
    return judged.select(
        "page_id", "host", "path", F.col("_rule.name").alias("rule"),
        F.when(allowed, F.lit("allow")).otherwise(F.lit("block")).alias("verdict"),
        (F.col("_step") * F.lit(BIN / SCALE)).alias("log_ratio"))
