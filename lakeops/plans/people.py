"""Features of people in work: contracts, pay, shifts and supplements (MART-27 to 31).

``entity`` is a person, ``day`` a date. Contracts, residences and pay are given as they were recorded, with gaps
and overlaps; bounds, labels and code lists are arguments. Frames hold one row per person and day (or month), so a
person's windows are as long as the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.clock import shift_end_seconds
from lakeops.functions.coding import band, code_map, first_rule, flag, slug
from lakeops.operators import intervals
from lakeops.operators.lookback import lookback
from lakeops.operators.summaries import exact_quantiles
from lakeops.operators.timeline import Timeline, along, last_known, next_known, position
from lakeops.plans.attendance import frequency_typology, value_runs


def contract_features(
    days: DataFrame,
    contracts: DataFrame,
    people: DataFrame,
    residences: DataFrame,
    order: Sequence[str],
    kinds: Mapping[str, str],
    tenure: Sequence[tuple[float, str]],
    longest: str,
    ages: Sequence[tuple[float, str]],
    oldest: str,
    children: Sequence[tuple[float, str]],
    most_children: str,
    full_time: float = 100.0,
    child_age: int = 20,
    missing: str = "missing",
) -> DataFrame:
    """MART-29: what holds for a person on a day.

    ``days``: (entity, day). ``contracts``: (entity, starts, ends, nature, hours_percent, and ``order``); of
    those that overlap the greatest in ``order`` holds, and after its end it holds on until the next begins.
    ``people``: (entity, born, hired, children: array of birth dates). ``residences``: (entity, since,
    place), each until the next one. A code of a contract's nature that ``kinds`` doesn't know, like no
    contract, is ``missing``. Ages are differences of calendar years; tenure is whole years of 365 days.
    A day without a contract yet has nulls and ``missing``.
    """
    entity = ["entity"]
    last = days.groupBy("entity").agg(F.max("day").alias("__last"))
    one = intervals.one_state(contracts, entity, "starts", "ends", order, ["nature", "hours_percent"])
    # Both tables have a row a person: Spark, who knows the size of their packed files, would broadcast them.
    known = one.join(last.hint("merge"), "entity").withColumn("__until", F.col("__last"))
    states = intervals.carried(known, entity, "starts", "ends", F.col("__until")).drop("__last", "__until")
    out = intervals.on_days(days.select("entity", "day").distinct(), states, entity, "day", "starts", "ends")
    # A residence holds until the next is known: the latest one on a merged timeline.
    moves = residences.select("entity", F.col("since").alias("day"), F.col("place").alias("__place"), F.lit(0).alias("__kind"))
    moves = moves.groupBy("entity", "day", "__kind").agg(F.max("__place").alias("__place"))
    line = Timeline(("entity",), ("day", "__kind"))
    placed = along(out.withColumn("__kind", F.lit(1)).unionByName(moves, allowMissingColumns=True), line, {"residence": last_known("__place")})
    out = placed.filter(F.col("__kind") == 1).drop("__kind", "__place").join(people.hint("merge"), "entity", "left")
    years = F.floor(F.datediff("day", "hired") / 365).cast("int")
    age = F.year("day") - F.year("born")
    young = F.size(F.filter(F.coalesce("children", F.array()), lambda born: F.year("day") - F.year(born) <= child_age))
    return out.select(
        "entity",
        "day",
        F.coalesce(code_map(F.trim("nature"), kinds), F.lit(missing)).alias("contract"),
        F.coalesce(F.col("day") >= F.col("carried_from"), F.lit(False)).alias("contract_carried"),
        flag(F.col("hours_percent") < full_time).alias("part_time"),
        years.alias("tenure_years"),
        F.coalesce(band(years, tenure, longest), F.lit(missing)).alias("tenure_band"),
        age.alias("age"),
        F.coalesce(band(age, ages, oldest), F.lit(missing)).alias("age_band"),
        young.alias("young_children"),
        band(young, children, most_children).alias("children_band"),
        "residence",
    )


def pay_features(
    pay: DataFrame, low: str = "0.3", high: str = "0.7", recent_days: int = 190, old_days: int = 890, missing: str = "missing"
) -> DataFrame:
    """MART-30: pay as for full time, its level among all people of the month, and how old the last change is.

    ``pay``: one row per (entity, month) with gross pay and monthly hours. Hours that are missing are the median
    of all; full time is that median. The level is ``low`` up to the lower quantile of the month, ``high`` from the
    upper one, and ``middle`` between. Months without pay take what their neighbours have, the earlier one first.
    """
    median = exact_quantiles(pay, "hours", {"m": "0.5"}).scalar()
    worked = F.coalesce(F.col("hours"), median).cast("double")
    equal = pay.withColumn("full_time_pay", F.col("gross").cast("double") / worked * median.cast("double"))
    bounds = exact_quantiles(equal, "full_time_pay", {"__low": low, "__high": high}, ["month"])
    rated = equal.join(bounds, "month", "left")
    value = F.col("full_time_pay")
    level = F.when(value <= F.col("__low"), "low").when(value >= F.col("__high"), "high").otherwise("middle")
    aged = value_runs(rated.withColumn("level", level).drop("__low", "__high"), "full_time_pay", "month", recent_days, old_days)
    names = ("full_time_pay", "level", "change_age")
    paid = aged.withColumns({f"__{n}": F.when(F.col("full_time_pay") != 0, F.col(n)) for n in names})
    sides = {f"__{n}_{side}": f(F.col(f"__{n}")) for n in names for side, f in (("back", last_known), ("ahead", next_known))}
    filled = along(paid, Timeline(("entity",), ("month",)), sides)
    chosen = [F.coalesce(f"__{n}_back", f"__{n}_ahead").alias(n) for n in names[:1]]
    chosen += [F.coalesce(f"__{n}_back", f"__{n}_ahead", F.lit(missing)).alias(n) for n in names[1:]]
    return filled.select("entity", "month", *chosen)


def shift_days(services: DataFrame, cutoff_hour: int = 4) -> DataFrame:
    """MART-27, first part: (entity, day) with the hour of the first start and of the last end, and the hours between.

    ``services``: (entity, day, start_s, end_s), seconds of the day; an end before ``cutoff_hour`` is on the next day.
    """
    ends = shift_end_seconds(F.col("start_s"), F.col("end_s"), cutoff_hour)
    spans = services.select("entity", "day", F.col("start_s").alias("__start"), ends.alias("__end"))
    days = spans.groupBy("entity", "day").agg(F.min("__start").alias("__start"), F.max("__end").alias("__end"))
    hour = lambda c: F.floor(F.pmod(F.col(c), F.lit(86400)) / 3600).cast("int")
    span = F.pmod(hour("__end") - hour("__start"), F.lit(24))
    return days.select("entity", "day", hour("__start").alias("start_hour"), hour("__end").alias("end_hour"), span.alias("span_hours"))


def working_time_profile(
    services: DataFrame, categories: Mapping[str, Mapping[str, Column]], thresholds: Mapping[str, tuple[str, float]],
    labels: Mapping[str, tuple[Sequence[str], str]], months: int = 3, cutoff_hour: int = 4,
) -> DataFrame:
    """MART-27: shift spans, the shares of their classes over the months before, flags on these, and labels.

    ``categories`` are conditions on start_hour, end_hour and span_hours; days whose span is 0 count for none. A
    share that is unknown, as over months without a shift, is taken from the day before or else after.
    ``labels`` maps a column to (flags, otherwise): the name of the first flag that is set.
    """
    shifts = shift_days(services, cutoff_hour)
    conditions = {n: c & (F.col("span_hours") != 0) for group in categories.values() for n, c in group.items()}
    marked = shifts.withColumns({f"__{n}": flag(c) for n, c in conditions.items()})
    counted = lookback(marked, "entity", "day", months, {f"__n_{n}": f"__{n}" for n in conditions})
    shares = {}
    for members in categories.values():
        total = sum((F.col(f"__n_{n}") for n in members), F.lit(0))
        shares |= {f"part_{n}": F.try_divide(F.col(f"__n_{n}"), total) for n in members}
    shared = counted.withColumns({f"__{n}": c for n, c in shares.items()})
    sides = {f"__{n}_{side}": f(F.col(f"__{n}")) for n in shares for side, f in (("back", last_known), ("ahead", next_known))}
    filled = along(shared, Timeline(("entity",), ("day",)), sides)
    filled = filled.withColumns({n: F.coalesce(f"__{n}_back", f"__{n}_ahead") for n in shares})
    flagged = filled.withColumns({out: flag(F.col(share) > bound) for out, (share, bound) in thresholds.items()})
    named = {out: first_rule([(F.col(f) == 1, f) for f in flags], otherwise) for out, (flags, otherwise) in labels.items()}
    return flagged.select(
        "entity", "day", "start_hour", "end_hour", "span_hours", *shares, *thresholds, *[c.alias(out) for out, c in named.items()]
    )


def comings_and_goings(days: DataFrame, spans: DataFrame, months: int = 3) -> DataFrame:
    """MART-28: days with whether the person came in ``(day - months, day]``, and leaves in ``[day, day + months)``.

    ``days``: one row per (entity, day); ``spans``: (entity, starts, ends) of contracts. An entry or exit counts
    on days of the frame only, as a person is there on them.
    """
    marks = spans.select("entity", F.explode(F.array(
        F.struct(F.col("starts").alias("day"), F.lit(1).alias("__in"), F.lit(0).alias("__out")),
        F.struct(F.col("ends").alias("day"), F.lit(0).alias("__in"), F.lit(1).alias("__out")),
    )).alias("m")).select("entity", "m.*").filter(F.col("day").isNotNull())
    marks = marks.groupBy("entity", "day").agg(F.max("__in").alias("__in"), F.max("__out").alias("__out"))
    marked = days.join(marks, ["entity", "day"], "left").fillna(0, ["__in", "__out"])
    seen = lookback(marked, "entity", "day", months, {"__came": "__in"}, include_today=True, include_edge=False).drop("days_seen")
    seen = lookback(seen, "entity", "day", months, {"__goes": "__out"}, ahead=True, include_today=True, include_edge=False)
    return seen.withColumns({"came": flag(F.col("__came") > 0), "leaves": flag(F.col("__goes") > 0)}).drop("__in", "__out", "__came", "__goes", "days_seen")


def moves_typology(
    rows: DataFrame, spans: DataFrame, rules: Sequence[tuple], otherwise: str, entry: str = "entry", leaving: str = "exit", months: int = 3
) -> DataFrame:
    """MART-28 in full: people who came or leave within ``months`` are classes of their own, before the rules on
    occurrences and days. ``rows`` are those of :func:`frequency_typology`."""
    moved = comings_and_goings(rows, spans, months)
    out = frequency_typology(moved, rules, otherwise, months)
    label = F.when(F.col("came") == 1, entry).when(F.col("leaves") == 1, leaving).otherwise(F.col("typology"))
    return out.withColumn("typology", label)


def supplement_lookback(paid: DataFrame, kind: str, amount: str, months: int, most: int | None = None) -> DataFrame:
    """MART-31: (entity, day, kind, number, amount_before, times_before) over ``(day - months, day]``, in long form.

    ``paid``: (entity, day, kind, amount). The kinds are found in the data and numbered by frequency, then name; one row
    per entity, day with a payment and kind paid in the months before: a day meets only the kinds whose payments
    still show on it. ``most`` keeps the most frequent kinds.
    """
    daily = paid.groupBy("entity", "day", kind).agg(F.sum(amount).alias("__amount"), F.count(F.lit(1)).alias("__times")).filter(F.col(kind).isNotNull())
    frequent = daily.groupBy(kind).agg(F.sum("__times").alias("__all"))
    # As many rows as there are kinds.
    numbered = along(frequent.withColumns({"__one": F.lit(1), "__less": -F.col("__all")}), Timeline(("__one",), ("__less", kind)), {"number": position()})
    numbered = numbered.select(kind, F.col("number").cast("int").alias("number"))
    if most is not None:
        numbered = numbered.filter(F.col("number") <= most)
    # A payment shows on days up to its last month's end; only these meet its kind.
    shown = daily.join(numbered.select(kind), kind, "left_semi").select("entity", kind, F.col("day").alias("__from"), F.add_months("day", months).alias("__to"))
    windows = intervals.union(shown, ["entity", kind], "__from", "__to")
    days = daily.select("entity", "day").distinct()
    met = intervals.on_days(days, windows, ["entity"], "day", "__from", "__to", "inner").select("entity", "day", kind)
    grid = met.join(numbered, kind).join(daily, ["entity", "day", kind], "left").fillna(0, ["__times"])
    grid = grid.withColumn("__amount", F.coalesce("__amount", F.lit(0).cast(daily.schema["__amount"].dataType)))
    keyed = grid.withColumn("__key", F.struct("entity", kind))
    seen = lookback(keyed, "__key", "day", months, {"amount_before": "__amount", "times_before": "__times"}, include_today=True, include_edge=False)
    return seen.filter(F.col("times_before") > 0).select("entity", "day", kind, "number", "amount_before", "times_before")


def wide_supplements(long: DataFrame, kind: str, kinds: Sequence[str], prefix: str = "paid_") -> DataFrame:
    """MART-31, wide form: one 0/1 column per kind of the caller's list."""
    flags = [F.max(flag(F.col(kind) == k)).alias(f"{prefix}{slug(k)}") for k in kinds]
    return long.groupBy("entity", "day").agg(*flags)

