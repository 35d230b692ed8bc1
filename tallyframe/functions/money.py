"""Exact money arithmetic as built-in column expressions.

Summing doubles gives answers that depend on row order, i.e. on partitioning.
So every amount is split into parts whose sums are exact and associative:

* ``whole`` and ``micros``: the whole part and millionths of amounts with up to
  six decimals.  This is every ordinary amount; its parts are computed in doubles.
* ``giga`` and ``exa`` (thousand millions and 10^18), ``pico`` and ``atto``
  (10^-12 and 10^-18): what else an amount of up to 28 digits before and 18
  after the point holds; whole and micros then hold the limb between.  They are
  computed in decimals, and are null for ordinary rows.

All are ``bigint`` and summed as longs without carrying, inside whole-stage
codegen; the sums are put together as decimals and rounded once.  Amounts of ``MAX_AMOUNT`` and more
are not summed: like text that is no number they count as null, and
``reports.rejected_amounts`` counts those rows.  Within that, sums never
overflow below 10^10 rows of the largest amount.

Text counts as a number if it is one in plain notation (``NUMBER``), so Java's
``12d`` does not; blanks around it are allowed.

All helpers return ``Column`` objects, so Catalyst sees plain ``Sum`` /
``Count`` aggregates and plans the usual partial + final aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

ColumnOrName = Column | str

# Amounts carry six decimals in their ordinary parts, results two.
MICROS_PER_UNIT = 1_000_000
RESULT_DECIMALS = 2
# Amounts from here on are not summed.
MAX_AMOUNT = 1e28
# A number in plain notation, with blanks around it.
NUMBER = r"^[ \t\n\r\f\x0B]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\f\x0B]*$"
# Below so many millionths, millionths of a double are met to less than half of one.
_FAST_BELOW = float(1 << 50)
_WHOLE_BELOW = 9e18
_GIGA, _EXA = 10**9, 10**18
# Totals from here on have no cents as doubles.
_CENTS_BELOW = Decimal(10**18)
# Parts of a sum, in the order that ``parts_amount`` takes them.
PARTS = ("whole", "micros", "giga", "exa", "pico", "atto")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value written, and computed, once.  For results of aggregates, not for rows."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _number(c: ColumnOrName) -> Column:
    # The type's name is a constant: numeric columns are not matched as text.
    c = _col(c)
    return F.when((F.typeof(c) != "string") | c.cast("string").rlike(NUMBER), c.try_cast("double"))


def lenient_number(c: ColumnOrName) -> Column:
    """Text (or any type) to double; unparseable text, NaN and infinities become null.

    Same answer with ANSI mode on or off, unlike an implicit cast.
    """
    number = _number(c)
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def summable(c: ColumnOrName) -> Column:
    """The amount as double, or null if it is no number or too large to be summed."""
    number = _number(c)
    return F.when(F.abs(number) < MAX_AMOUNT, number)


def _fast(x: Column) -> Column:
    """Condition: a number of millionths, up to the rounding of the double that holds it."""
    micros = x * MICROS_PER_UNIT
    return (F.abs(micros) < _FAST_BELOW) & (F.abs(micros - F.rint(micros)) <= F.abs(micros) * 2.3e-16)


def _through(x: Column) -> Column:
    """Condition: larger, with six decimals at most."""
    # Compared with 18 decimals; a comparison of the two types would drop to six.
    six = x.try_cast("decimal(38,6)").try_cast("decimal(38,18)")
    return (F.abs(x) < _WHOLE_BELOW) & (x.try_cast("decimal(38,18)") == six)


def _fast_micros(x: Column) -> Column:
    return F.rint(x * MICROS_PER_UNIT).cast("bigint")


def _rare(x: Column) -> Column:
    return ~_fast(x) & ~_through(x) & (F.abs(x) < MAX_AMOUNT)


def _wide(x: Column) -> Column:
    """The whole part as ``decimal(28,0)``; doubles too large for 18 decimals are whole."""
    exact = x.try_cast("decimal(38,18)")
    return F.coalesce((exact - exact % 1).try_cast("decimal(28,0)"), x.try_cast("decimal(28,0)"))


def _fine(x: Column) -> Column:
    """What stands behind the point, as ``decimal(18,18)``."""
    return F.coalesce(x.try_cast("decimal(38,18)") % 1, F.lit(Decimal(0))).cast("decimal(18,18)")


def _limb(number: Column, unit: int) -> Column:
    unit_ = F.lit(Decimal(unit))
    return ((number - number % unit_) / unit_).cast("bigint")


def whole_part(c: ColumnOrName) -> Column:
    """The whole part of an ordinary amount, towards zero, as ``bigint``; of others what is below ``giga``."""
    x = _number(c)
    micros = _fast_micros(x)
    return F.when(_fast(x), F.floor(F.abs(micros) / MICROS_PER_UNIT) * F.signum(micros).cast("bigint")).when(
        _through(x), x.try_cast("decimal(38,6)").try_cast("bigint")).when(_rare(x), (_wide(x) % _GIGA).cast("bigint"))


def micro_part(c: ColumnOrName) -> Column:
    """Signed millionths beside the whole part, as ``bigint``."""
    x = _number(c)
    return F.when(_fast(x), _fast_micros(x) % MICROS_PER_UNIT).when(
        _through(x), ((x.try_cast("decimal(38,6)") % 1) * MICROS_PER_UNIT).cast("bigint")).when(
        _rare(x), (_fine(x) * MICROS_PER_UNIT).cast("bigint"))


def _rare_parts(c: ColumnOrName) -> tuple[Column, Column, Column, Column]:
    x = _number(c)
    wide, fine, exa = _wide(x), _fine(x), F.lit(Decimal(_EXA))
    pico = (fine * MICROS_PER_UNIT) % 1 * MICROS_PER_UNIT
    atto = (fine * F.lit(Decimal(10**12))) % 1 * MICROS_PER_UNIT
    made = (_limb(wide % exa, _GIGA), _limb(wide, _EXA), pico.cast("bigint"), atto.cast("bigint"))
    return tuple(F.when(_rare(x), part) for part in made)


def money_parts(c: ColumnOrName, name: str) -> dict[str, Column]:
    """The per-row measures of an amount, to be summed under these names."""
    made = (whole_part(c), micro_part(c), *_rare_parts(c))
    return {f"{name}_{part}": column for part, column in zip(PARTS, made, strict=True)}


def part_names(name: str) -> list[str]:
    """The names that ``money_parts`` gives, in the order of ``parts_amount``."""
    return [f"{name}_{part}" for part in PARTS]


def _put(parts: list[Column]) -> tuple[Column, Column]:
    """Summed parts as whole units, ``decimal(38,0)``, null if nothing was summed, and the rest, ``decimal(36,18)``."""
    whole, micros, giga, exa, pico, atto = [F.coalesce(part.cast("decimal(19,0)"), F.lit(Decimal(0))) for part in parts]
    units = whole + giga * F.lit(Decimal(_GIGA)) + exa * F.lit(Decimal(_EXA))
    of = lambda part, unit: (part * F.lit(Decimal(1).scaleb(unit))).cast("decimal(35,18)")
    rest = (of(micros, -6) + of(pico, -12) + of(atto, -18)).cast("decimal(36,18)")
    return F.when(parts[0].isNotNull(), units.cast("decimal(38,0)")), rest


def _joined(parts: list[ColumnOrName], use: Callable[..., Column], n: Column | None = None) -> Column:
    """``use`` of the summed parts as ``_put`` gives them, and of ``n``, a count, if there is one.

    Parts that are left out were never summed.
    """
    given = [_col(part) for part in parts] + [F.lit(None)] * (len(PARTS) - len(parts))
    summed = F.struct(*[part.cast("bigint").alias(name) for name, part in zip(PARTS, given, strict=True)],
                      (F.lit(1) if n is None else n).cast("bigint").alias("n"))

    def put(s: Column) -> Column:
        units, rest = _put([s[name] for name in PARTS])
        return F.struct(units.alias("units"), rest.alias("rest"), s["n"].alias("n"))

    args = (lambda j: (j["units"], j["rest"])) if n is None else (lambda j: (j["units"], j["rest"], j["n"]))
    return _bound(_bound(summed, put), lambda j: use(*args(j)))


def _small(units: Column, rest: Column) -> Column:
    """Units and rest as one decimal with 18 decimals; null from 10^18 on."""
    return F.when(F.abs(units) < _CENTS_BELOW, (units.try_cast("decimal(36,18)") + rest).cast("decimal(38,18)"))


def _as_double(decimals: int | None) -> Callable[[Column, Column], Column]:
    def use(units: Column, rest: Column) -> Column:
        small = _small(units, rest)
        small = small if decimals is None else F.round(small, decimals)
        return F.coalesce(small.cast("double"), (units + F.round(rest, 0)).cast("double"))

    return use


def parts_total(*parts: ColumnOrName) -> Column:
    """Summed parts as an exact decimal with 18 decimals; null from 10^18 on."""
    return _joined(list(parts), _small)


def parts_amount(*parts: ColumnOrName) -> Column:
    """Summed parts as a double, rounded half up to two decimals."""
    return _joined(list(parts), _as_double(RESULT_DECIMALS))


# The same arithmetic as SQL text, over columns that hold the stages.  A report
# that goes through them is planned from a few parsed expressions; the functions
# above nest everything in one.

def sql_number(amount: str) -> str:
    """Text as a number in plain notation, else null."""
    return f"CASE WHEN {amount} RLIKE r'{NUMBER}' THEN TRY_CAST({amount} AS DOUBLE) END"


def sql_micros(x: str) -> str:
    """The millionths of an ordinary amount as ``bigint``; null for others."""
    micros = f"{x} * {MICROS_PER_UNIT}"
    fast = f"ABS({micros}) < {_FAST_BELOW!r}D AND ABS({micros} - RINT({micros})) <= ABS({micros}) * 2.3e-16D"
    return f"CASE WHEN {fast} THEN CAST(RINT({micros}) AS BIGINT) END"


def sql_parts(x: str, m: str) -> dict[str, str]:
    """Per row: the parts to be summed, and ``n``, which is not null if the amount counts."""
    rare = f"{m} IS NULL AND ABS({x}) < {MAX_AMOUNT!r}D"
    exact = f"TRY_CAST({x} AS DECIMAL(38,18))"
    # Doubles too large for 18 decimals are whole.
    wide = f"COALESCE(CAST({exact} - {exact} % 1 AS DECIMAL(28,0)), TRY_CAST({x} AS DECIMAL(28,0)))"
    fine = f"CAST(COALESCE({exact}, 0) % 1 AS DECIMAL(18,18))"
    limbs = {
        "whole": f"{wide} % {_GIGA}BD",
        "micros": f"{fine} * {MICROS_PER_UNIT}",
        "giga": f"({wide} % {_EXA}BD) DIV {_GIGA}BD",
        "exa": f"{wide} DIV {_EXA}BD",
        "pico": f"({fine} * {MICROS_PER_UNIT}) % 1 * {MICROS_PER_UNIT}",
        "atto": f"({fine} * {10**12}BD) % 1 * {MICROS_PER_UNIT}",
    }
    ordinary = {"whole": f"WHEN {m} IS NOT NULL THEN {m} DIV {MICROS_PER_UNIT} ", "micros": f"WHEN {m} IS NOT NULL THEN {m} % {MICROS_PER_UNIT} "}
    parts = {part: f"CASE {ordinary.get(part, '')}WHEN {rare} THEN CAST({limb} AS BIGINT) END" for part, limb in limbs.items()}
    return parts | {"n": f"CASE WHEN {m} IS NOT NULL OR {rare} THEN 1 END"}


def sql_units(whole: str, giga: str, exa: str) -> str:
    """Summed parts as whole units, ``decimal(38,0)``; null if nothing was summed."""
    of = lambda part, unit: f"COALESCE(CAST({part} AS DECIMAL(19,0)), 0) * {unit}BD"
    return f"CASE WHEN {whole} IS NOT NULL THEN CAST({of(whole, 1)} + {of(giga, _GIGA)} + {of(exa, _EXA)} AS DECIMAL(38,0)) END"


def sql_rest(micros: str, pico: str, atto: str) -> str:
    """What stands beside the units, ``decimal(36,18)``."""
    of = lambda part, places: f"CAST(COALESCE(CAST({part} AS DECIMAL(19,0)), 0) * 0.{'1'.zfill(places)}BD AS DECIMAL(35,18))"
    return f"CAST({of(micros, 6)} + {of(pico, 12)} + {of(atto, 18)} AS DECIMAL(36,18))"


def _sql_small(units: str, rest: str) -> str:
    return f"CAST(TRY_CAST({units} AS DECIMAL(36,18)) + {rest} AS DECIMAL(38,18))"


def sql_double(units: str, rest: str, rounded: bool) -> str:
    """The total as a double, rounded half up to two decimals or as it is."""
    small = f"ROUND({_sql_small(units, rest)}, {RESULT_DECIMALS})" if rounded else _sql_small(units, rest)
    return (f"CASE WHEN ABS({units}) < {_CENTS_BELOW}BD THEN CAST({small} AS DOUBLE) "
            f"ELSE CAST({units} + ROUND({rest}, 0) AS DOUBLE) END")


def sql_mean(units: str, rest: str, n: str) -> str:
    """The unrounded average as a double."""
    return f"({sql_double(units, rest, False)}) / CASE WHEN {n} > 0 THEN {n} END"


def sql_avg(units: str, rest: str, n: str) -> str:
    """The average as a double, rounded half up to the cent."""
    size = f"ABS({_sql_small(units, rest)})"
    # Twice the cents, without what lies below half a cent: n is whole, so that cannot tip the rounding.
    halves = f"(CAST(FLOOR({size}) AS DECIMAL(20,0)) * 200 + FLOOR(CAST({size} % 1 AS DECIMAL(18,18)) * 200))"
    cents = f"CAST((2 * {halves} + 2 * {n}) DIV (4 * {n}) AS DOUBLE)"
    sign = f"CASE WHEN {units} + {rest} < 0 THEN -1 ELSE 1 END"
    return (f"CASE WHEN {n} > 0 THEN CASE WHEN ABS({units}) < {_CENTS_BELOW}BD THEN {sign} * {cents} / 100 "
            f"ELSE {sql_mean(units, rest, n)} END END")


def staged_amount(df: DataFrame, amount: ColumnOrName, name: str) -> DataFrame:
    """``df`` with the amount as double under ``name`` and its millionths, if ordinary, under ``name_m``."""
    column = _col(amount)
    kind = (df if isinstance(amount, str) and amount in df.columns else df.select(column.alias("x"))).schema[
        amount if isinstance(amount, str) and amount in df.columns else "x"].dataType
    number = column.cast("double") if isinstance(kind, NumericType) else _number(column)
    return df.select("*", number.alias(name)).select("*", F.expr(sql_micros(f"`{name}`")).alias(f"{name}_m"))


def staged_parts(name: str) -> dict[str, Column]:
    """Per row of a ``staged_amount``: the measures that ``money_parts`` gives, under the same names."""
    made = sql_parts(f"`{name}`", f"`{name}_m`")
    return {f"{name}_{part}": F.expr(made[part]) for part in PARTS}


def staged_sums(name: str) -> list[Column]:
    """Aggregates of a ``staged_amount``: its sums and the count of what was summed."""
    made = sql_parts(f"`{name}`", f"`{name}_m`")
    return [F.expr(f"{'COUNT' if part == 'n' else 'SUM'}({text}) AS `{name}_{part}`") for part, text in made.items()]


def staged_results(sums: DataFrame, *names: str) -> DataFrame:
    """``sums`` with the sums of each ``staged_amount`` put together: ``name_units`` and ``name_rest``."""
    out = []
    for name in names:
        at = {part: f"`{name}_{part}`" for part in PARTS}
        out += [f"{sql_units(at['whole'], at['giga'], at['exa'])} AS `{name}_units`",
                f"{sql_rest(at['micros'], at['pico'], at['atto'])} AS `{name}_rest`"]
    return sums.selectExpr("*", *out)


def staged_sum(name: str) -> Column:
    """The sum rounded to two decimals, as ``exact_sum``."""
    return F.expr(sql_double(f"`{name}_units`", f"`{name}_rest`", True))


def staged_double(name: str) -> Column:
    """The double next to the sum, as ``exact_double``."""
    return F.expr(sql_double(f"`{name}_units`", f"`{name}_rest`", False))


def staged_mean(name: str) -> Column:
    """The unrounded average, as ``exact_mean``."""
    return F.expr(sql_mean(f"`{name}_units`", f"`{name}_rest`", f"`{name}_n`"))


def staged_avg(name: str) -> Column:
    """The average rounded to two decimals, as ``exact_avg``."""
    return F.expr(sql_avg(f"`{name}_units`", f"`{name}_rest`", f"`{name}_n`"))


def _sums(c: ColumnOrName) -> list[Column]:
    return [F.sum(part) for part in money_parts(c, "sum").values()]


def exact_total(c: ColumnOrName) -> Column:
    """Aggregate: the unrounded sum of an amount, as a decimal; null from 10^18 on."""
    return parts_total(*_sums(c))


def exact_sum(c: ColumnOrName) -> Column:
    """Aggregate: sum of an amount, rounded once to two decimals, as double."""
    return parts_amount(*_sums(c))


def exact_double(c: ColumnOrName) -> Column:
    """Aggregate: the double next to the exact sum of an amount."""
    return _joined(_sums(c), _as_double(None))


def exact_decimal(c: ColumnOrName) -> Column:
    """Aggregate: sum of an amount, rounded half up to two decimals, as ``decimal(38,2)``: exact at any size."""
    def use(units: Column, rest: Column) -> Column:
        return (units.try_cast("decimal(38,2)") + F.round(rest, RESULT_DECIMALS)).try_cast("decimal(38,2)")

    return _joined(_sums(c), use)


def exact_mean(c: ColumnOrName) -> Column:
    """Aggregate: unrounded average, the exact sum over the count, as double."""
    return exact_double(c) / F.count(summable(c))


def half_up_div(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` rounded half away from zero to an integer.

    Computed as floor((2|n| + d) / 2d) on whole decimals: the remainder is
    taken off first, so the division is exact.  Null when the denominator is
    not positive.
    """
    d = F.when(denominator > 0, denominator).cast("decimal(25,0)")
    top = F.abs(numerator).cast("decimal(29,0)") * 2 + d
    bottom = d * 2
    magnitude = ((top - top % bottom) / bottom).cast("bigint")
    return F.when(numerator < 0, -magnitude).otherwise(magnitude)


def _average(units: Column, rest: Column, n: Column) -> Column:
    """The total over the count, rounded half up to two decimals."""
    per_unit = 10**RESULT_DECIMALS

    def cents(p: Column) -> Column:
        # Twice the cents, without what lies below half a cent: n is whole, so that cannot tip the rounding.
        total = p["total"]
        fraction = (F.abs(total) % 1).cast("decimal(18,18)")
        whole = F.floor(F.abs(total)).cast("decimal(20,0)")
        halves = (whole * (2 * per_unit) + F.floor(fraction * (2 * per_unit))).cast("decimal(29,0)")
        signed = F.when(total < 0, -halves).otherwise(halves)
        return _bound(F.struct(signed.alias("top"), (p["n"] * 2).alias("bottom")), lambda q: half_up_div(q["top"], q["bottom"]))

    small = _bound(F.struct(_small(units, rest).alias("total"), n.alias("n")), cents)
    # Beyond 10^18 a double has no cents.
    return F.coalesce(small.cast("double") / float(per_unit), (units + F.round(rest, 0)).cast("double") / F.when(n > 0, n))


def exact_avg(c: ColumnOrName) -> Column:
    """Aggregate: average of an amount rounded half up to the cent, as double.

    Null values are skipped, as ``avg`` does; a group with no values gives null.
    """
    return _joined(_sums(c), _average, F.count(summable(c)))
