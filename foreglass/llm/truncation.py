"""Problem 3: texts cut off by field limits or in transfer.

Method: discrete length hazards of each source by window functions, tested
against the neighbouring hazards under false-discovery control. Field limits
show as single lengths, broken transfers as a hazard of incomplete endings over
whole bands of lengths; incomplete endings are flagged with the hazard they
come from, doubtful ones by the hazard of their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foreglass.session import cut

#: Lengths to each side that a length is compared with.
NEIGHBOURS = 20
#: False-discovery rate of the significant lengths.
RATE = 0.01
#: Share of finished numbers after a word below which a number that ends a text after it is a cut decimal.
RARE = 0.05

#: Share of finished texts whose ending may look incomplete: what the hazard of broken transfers is tested against.
FALSE_ALARMS = 0.001
#: So many of them are expected in any band, however few its texts are.
LEAST_EXPECTED = 0.1

COMPLETE, INCOMPLETE, DOUBTFUL = 0, 1, 2


def ending(text: Column, outcomes: Column) -> Column:
    """How a text ends: complete, incomplete, or doubtful (a full stop after a bare number may be a decimal point).

    Null and blank texts are complete. Complete ends are a finished sentence, a
    closed object or tag, or outcome lines (``name: number``) that list all
    names of the JSON object ``outcomes`` or sum to one. White space at the end
    does not count.
    """
    s = F.regexp_replace(text, r"(\s|\p{Z})+$", "")
    bare = F.regexp_replace(s, r"\s*```$", "")
    back = F.reverse(bare)
    opened, closed = F.locate("{", back), F.locate("}", back)
    inside = (opened > 0) & ((closed == 0) | (opened < closed))
    last = F.substring_index(bare, "\n", -1)
    lines = F.filter(F.split(bare, "\n"), lambda x: x.rlike(r"^.*\S: \d+(\.\d+)?%?$"))
    names = F.transform(lines, lambda x: F.regexp_replace(F.regexp_extract(x, r"^(.*\S): \d+(?:\.\d+)?%?$", 1), r"^[-*•\s]+", ""))
    figures = F.transform(lines, lambda x: F.regexp_extract(x, r": (\d+(?:\.\d+)?)%?$", 1))
    decimals = F.transform(figures, lambda x: F.length(F.regexp_extract(x, r"\.(\d+)$", 1)))
    total = F.aggregate(figures, F.lit(0.0), lambda a, x: a + F.coalesce(x.try_cast("double"), F.lit(0.0)))
    wanted = F.map_keys(F.from_json(outcomes, "map<string,string>"))
    listed = F.coalesce(F.forall(wanted, lambda k: F.array_contains(names, k)), F.lit(False))
    whole = (listed | total.between(0.95, 1.05) | total.between(95, 105)) & (F.element_at(decimals, -1) == F.array_max(decimals))
    outcome_lines = last.rlike(r"^.*\S: \d+(\.\d+)?%?$") & F.when(F.size(lines) > 0, whole).otherwise(False)
    item = last.rlike(r"^\s*([-*•#>]+|\d+[.)])$")
    dots = bare.rlike(r"(\.\.\.|\.\. \.|…|。。)[\"”’»')\]*_]*$")
    sentence = bare.rlike(r"[.!?。！？؟।][\"”’»')\]*_]*$") & ~dots & ~item
    number = bare.rlike(r"(^|[^\d.,\-/:])\d+\.$")
    return (
        F.when(text.isNull() | (s == ""), COMPLETE)
        .when(inside, INCOMPLETE)
        .when(bare.rlike(r"</[\w:-]+>$") | bare.rlike(r"\}\s*\]?$"), COMPLETE)
        .when(sentence & number, DOUBTFUL).when(sentence, COMPLETE)
        .when(outcome_lines, COMPLETE)
        .otherwise(INCOMPLETE)
    )


def measured(df: DataFrame, identifier: str, source: str, text: str, outcomes: str) -> DataFrame:
    """One row for each identifier: source, length in characters and bytes, kind of ending, and the word before a last number."""
    word = F.regexp_extract(text, r"(\S+)\s+\S*\d+\.\s*$", 1)
    rows = df.select(F.col(identifier).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), ending(F.col(text), F.col(outcomes)).alias("ending"), F.when(F.col(text).rlike(r"\d\.\s*$"), word).alias("word"))
    kept = F.struct("source", "chars", "bytes", "ending", "word")
    return rows.filter("id is not null").groupBy("id").agg(F.min(kept).alias("r")).select("id", "r.*")


def number_words(df: DataFrame, identifier: str, source: str, text: str) -> DataFrame:
    """``(source, word, decimals, finished)``: how often a word stands before a decimal and before a number that ends a sentence, inside the texts of a source."""
    number = r"(?<!\S)(\S+)(?=[^\S\n]+\S*?(?<![\d.,\-/:])\d+\."

    def before(after: str, decimal: int) -> Column:
        found = F.regexp_extract_all(text, F.lit(number + after), 1)
        return F.transform(found, lambda w: F.struct(w.alias("word"), F.lit(decimal).alias("decimal")))

    both = F.concat(before(r"\d)", 1), before(r"\s+\S)", 0))
    rows = df.select(F.col(identifier).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("source"), both.alias("words")).filter("id is not null")
    one = rows.groupBy("id").agg(F.min(F.struct("source", "words")).alias("r"))
    words = one.select("r.source", F.explode("r.words").alias("w")).select("source", "w.word", "w.decimal")
    return words.groupBy("source", "word").agg(F.sum("decimal").alias("decimals"), F.sum(1 - F.col("decimal")).alias("finished"))


def significant_lengths(rows: DataFrame, neighbours: int = NEIGHBOURS, rate: float = RATE) -> DataFrame:
    """``(source, unit, length, n, hazard, expected, p)``: lengths at which far more texts end than at the lengths around.

    The hazard of a length is the share of the texts at least that long that
    end there. Its count is tested against what the hazards of the
    neighbouring lengths let expect, by the Chernoff bound of the Poisson
    tail, or what their counts let expect if that is more: hazards rise by
    themselves where a distribution ends. Per source and unit the false-discovery rate is controlled by
    Benjamini and Hochberg's rule. Rows are counted by length first, so what
    reaches the windows is at most one row for each length.
    """
    units = rows.filter("chars > 0").select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("x"))
    counts = units.groupBy("source", F.col("x.unit").alias("unit"), F.col("x.length").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    each = Window.partitionBy("source", "unit")
    longer = each.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    around = each.orderBy("length").rangeBetween(-neighbours, neighbours)
    hazards = counts.withColumn("risk", F.sum("n").over(longer)).withColumn("hazard", F.col("n") / F.col("risk"))
    near = (F.sum("n").over(around) - F.col("n") + 0.5) / (2 * neighbours * F.avg("risk").over(around))
    below = F.sum("n").over(each.orderBy("length").rangeBetween(-neighbours, -1)) / neighbours
    above = F.sum("n").over(each.orderBy("length").rangeBetween(1, neighbours)) / neighbours
    tested = hazards.withColumn("expected", F.greatest(F.col("risk") * near, below, above))
    return _significant(tested, rate).select("source", "unit", "length", "n", "hazard", "expected", "p")


def _significant(tested: DataFrame, rate: float) -> DataFrame:
    """Rows with more texts ``n`` than ``expected``, by Chernoff's bound, with the false-discovery rate controlled per source and unit."""
    each = Window.partitionBy("source", "unit")
    n, e = F.col("n"), F.col("expected")
    tested = tested.withColumn("p", F.when(n > e, F.exp(n - e - n * F.log(n / e))).otherwise(1.0))
    ranked = tested.withColumn("pass", F.col("p") <= rate * F.row_number().over(each.orderBy("p", "length")) / F.count(F.lit(1)).over(each))
    limited = ranked.withColumn("limit", F.max(F.when(F.col("pass"), F.col("p"))).over(each))
    return limited.filter("p <= limit")


def _band(chars: Column) -> Column:
    """The lower end of the band of lengths, each twice as long as the one before."""
    return F.pow(F.lit(2.0), F.floor(F.log2(chars.cast("double")))).cast("int")


def transfer_hazards(rows: DataFrame, alarms: float = FALSE_ALARMS, rate: float = RATE) -> DataFrame:
    """``(source, unit, length, n, hazard, expected, p)`` of the bands of lengths, from ``length`` on, in which texts break off.

    A transfer breaks at any length, so the hazard is that of an incomplete
    ending at no significant length, over a band: the share of the texts at
    least that long that break off within it. Its count is tested against the
    incomplete endings that finished texts of the band may seem to have, at least
    ``LEAST_EXPECTED``. At most some dozens of bands reach the windows for each source.
    """
    broken = (F.col("ending") == INCOMPLETE) & ~F.col("at_limit")
    bands = rows.filter("chars > 0").groupBy("source", _band(F.col("chars")).alias("length")).agg(F.count(F.lit(1)).alias("ends"), F.count_if(broken).alias("n"))
    longer = Window.partitionBy("source").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    tested = bands.withColumn("hazard", F.col("n") / F.sum("ends").over(longer)).withColumn("expected", F.greatest(alarms * F.col("ends"), F.lit(LEAST_EXPECTED))).withColumn("unit", F.lit("transfer"))
    return _significant(tested.filter("n > 0"), rate).select("source", "unit", "length", "n", "hazard", "expected", "p")


def _at_limits(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """``rows`` with ``at_limit``: whether the text ends at a significant length of its source."""
    limits = lambda unit: lengths.filter(F.col("unit") == unit).select("source", F.col("length").alias(unit), F.lit(True).alias(f"limit_{unit}"))
    joined = rows.join(limits("chars"), ["source", "chars"], "left").join(limits("bytes"), ["source", "bytes"], "left")
    return joined.withColumn("at_limit", F.coalesce("limit_chars", "limit_bytes", F.lit(False))).drop("limit_chars", "limit_bytes")


def truncated(df: DataFrame, identifier: str, source: str, text: str, outcomes: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, hazards)``: each identifier with ``source``, ``truncated`` and the ``evidence`` for it; the significant hazards.

    Every text is placed by the hazards. One with an incomplete ending is cut
    by a field limit if its length is significant (evidence ``length``), broken
    in transfer if its band of lengths has a hazard of incomplete endings
    (``transfer``), and else truncated by its ending alone (``ending``).
    Doubtful ends are judged by the word before the number, as it stands
    inside the texts of the same source: at a significant length they count as
    incomplete unless the word precedes finished numbers at least as often as
    decimals (``length``), elsewhere only if it almost never precedes finished
    ones (a smoothed share below ``RARE``; ``ending``). Null and blank texts
    are not truncated; identifiers count once, of differing copies the first
    by source and length; null identifiers are left out; a null source is the
    source ''. Nothing is broadcast by hint; the hazards are joined by source and
    length, so a hot source spreads over its lengths.
    """
    rows = cut(measured(df, identifier, source, text, outcomes))
    lengths = cut(significant_lengths(rows))
    rows = cut(_at_limits(rows, lengths))
    transfers = cut(transfer_hazards(rows))
    band = transfers.select("source", F.col("length").alias("band"), F.lit(True).alias("breaking"))
    placed = rows.withColumn("band", _band(F.col("chars"))).join(band, ["source", "band"], "left")
    judged = rows.filter(F.col("ending") == DOUBTFUL).join(number_words(df, identifier, source, text), ["source", "word"], "left").fillna(0, ["decimals", "finished"])
    usual = (F.col("finished") > 0) & (F.col("finished") >= F.col("decimals"))
    rare = (F.col("finished") + 1) / (F.col("finished") + F.col("decimals") + 2) < RARE
    broken = judged.filter(F.when(F.col("at_limit"), ~usual).otherwise(rare)).select("id", F.lit(True).alias("broken"))
    by_length = F.when(F.col("at_limit"), "length")
    evidence = F.when(F.col("ending") == INCOMPLETE, F.coalesce(by_length, F.when(F.col("breaking"), "transfer"), F.lit("ending"))).when(F.col("broken"), F.coalesce(by_length, F.lit("ending")))
    out = placed.join(broken, "id", "left").select("id", "source", evidence.isNotNull().alias("truncated"), evidence.alias("evidence"))
    return out.withColumnRenamed("id", identifier), lengths.union(transfers)


def truncation_rates(rows: DataFrame) -> DataFrame:
    """How often each source truncates, in all and by evidence."""
    n, of = F.count(F.lit(1)), lambda kind: F.count_if(F.col("evidence") == kind)
    return rows.groupBy("source").agg(n.alias("n"), F.count_if("truncated").alias("n_truncated"), (F.count_if("truncated") / n).alias("share"), of("length").alias("n_length"), of("transfer").alias("n_transfer"), of("ending").alias("n_ending"))
