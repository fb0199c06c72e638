"""Exact token amounts with built-in Spark expressions.

Two column types hold an amount:

``decimal38``  DECIMAL(38,0), for data known to fit 38 digits. Overflow raises.
``u256``       STRUCT<w0 .. w4> of BIGINT, most significant word first: w1 to w4 hold 60 bits each and w0
               the top 16 bits of 0 .. 2^256-1.

A 256-bit sum adds 13 slices of 20 bits as BIGINT sums and carries once, after the aggregate. So it stays
in whole-stage code and in a hash aggregate with partial sums (wide decimal sums allocate big numbers per
row and are many times slower), and one group can add up 8 x 10^12 amounts of any size before a slice sum
would overflow, which raises instead of wrapping. A signed amount keeps its sign in ``w0``; the other
words stay in 0 .. 2^60-1, so struct comparison is the numeric order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 5
WORD_BITS = 60
SLICE_BITS = 20
DIGITS = 78
# Digits are read and rendered in groups that a product with a 30-bit part leaves room for in a BIGINT.
TEXT_GROUP, TEXT_GROUPS = 8, 10
DECIMAL38 = T.DecimalType(38, 0)
U256 = T.StructType([T.StructField(f"w{i}", T.LongType()) for i in range(WORDS)])


def _big(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _decimal(n: int) -> Column:
    return F.lit(str(n)).cast(T.DecimalType(len(str(n)), 0))


def _low_bits(number: Column, bits: int) -> Column:
    """Also of negative numbers: two's complement makes this the floor remainder."""
    return number.bitwiseAND(_big(2**bits - 1))


def _words(value: Column) -> list[Column]:
    return [value[f"w{i}"] for i in range(WORDS)]


def _amount(words: list[Column]) -> Column:
    return F.struct(*(word.cast("bigint").alias(f"w{i}") for i, word in enumerate(words)))


def _carried(parts: list[Column], bits: int) -> list[Column]:
    """Carry parts of ``bits`` bits (most significant first) upwards; the first part takes the rest."""
    result, carry = [], None
    for part in reversed(parts[1:]):
        value = part if carry is None else part + carry
        result.append(_low_bits(value, bits))
        carry = F.shiftright(value, bits)
    return [parts[0] + carry, *reversed(result)]


def _join_bits(parts: list[Column], bits: int) -> Column:
    joined = parts[-1]
    for place, part in enumerate(reversed(parts[:-1]), start=1):
        joined = joined + F.shiftleft(part, place * bits)
    return joined


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once. Without it, each reuse copies the whole expression, and
    nested reuse grows exponentially. Lambdas leave generated code, so only text conversions use this."""
    return F.transform(F.array(value), use)[0]


def u256_from_hex(digits: Column) -> Column:
    """64 hex digits without a prefix."""
    starts = [(1, 4), (5, 15), (20, 15), (35, 15), (50, 15)]
    return _amount([F.conv(F.substring(digits, start, size), 16, 10) for start, size in starts])


def u256_from_long(number: Column) -> Column:
    """Non-negative BIGINT."""
    zero = _big(0)
    return _amount([zero, zero, zero, F.shiftright(number, WORD_BITS), _low_bits(number, WORD_BITS)])


def u256_from_text(text: Column) -> Column:
    """Decimal digits; more than 78 of them raise.

    Ten groups of 8 digits are multiplied by the 30-bit parts of their powers of ten. At most ten products of 57
    bits meet in one place, which a BIGINT holds, so one carry is enough.
    """
    too_long = F.raise_error(F.lit(f"amount has more than {DIGITS} digits"))
    width = TEXT_GROUP * TEXT_GROUPS
    padded = F.when(F.length(text) > DIGITS, too_long).when(text.rlike("[^0-9]"), F.lit("x" * width)).otherwise(F.lpad(text, width, "0"))
    bits, places = 30, 9

    def split(digits: Column) -> Column:
        return F.array(*(F.substring(digits, 1 + TEXT_GROUP * i, TEXT_GROUP).cast("bigint") for i in range(TEXT_GROUPS)))

    def multiply(groups: Column) -> Column:
        sums = [None] * places
        for group in range(TEXT_GROUPS):
            scale = 10 ** (TEXT_GROUP * (TEXT_GROUPS - 1 - group))
            for place in range(places):
                factor = scale >> (bits * place) & (2**bits - 1)
                if factor:
                    term = groups[group] * _big(factor)
                    sums[place] = term if sums[place] is None else sums[place] + term
        return F.array(*(_big(0) if s is None else s for s in reversed(sums)))

    def pack(sums: Column) -> Column:
        limbs = _carried([sums[i] for i in range(places)], bits)
        return _amount([limbs[0], *(_join_bits(limbs[i : i + 2], bits) for i in range(1, places, 2))])

    return _bind(_bind(_bind(padded, split), multiply), pack)


class DecimalAmounts:
    """Operations on DECIMAL(38,0) amounts."""

    def total(self, value: Column) -> Column:
        return F.sum(value.cast(DECIMAL38)).cast(DECIMAL38)

    def partial_sums(self, name: str, value: Column) -> list[Column]:
        return [self.total(value).alias(name)]

    def finish_sums(self, df: DataFrame, names: list[str]) -> DataFrame:
        return df

    def positive_sum(self, name: str) -> Column:
        return F.col(name) > 0

    def zero(self) -> Column:
        return F.lit(0).cast(DECIMAL38)

    def negate(self, value: Column) -> Column:
        return (-value).cast(DECIMAL38)

    def only_if(self, condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(self.zero())

    def net(self, received: Column, sent: Column, value: Column) -> Column:
        """The change one transfer makes to an account that received it, sent it, or did both."""
        return (self.only_if(received, value) - self.only_if(sent, value)).cast(DECIMAL38)

    def positive(self, value: Column) -> Column:
        return value > 0

    def exceeds(self, value: Column, bound: int) -> Column:
        return value > _decimal(bound)

    def to_double(self, value: Column) -> Column:
        return value.cast("double")

    def to_text(self, value: Column) -> Column:
        return value.cast("string")

    def summary(self, t: DataFrame, keys: list[str]) -> DataFrame:
        """Per key: ``transfer_count``, ``total_volume``, ``largest_transfer``."""
        return t.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("transfer_count"),
            self.total(F.col("value")).alias("total_volume"),
            F.max("value").alias("largest_transfer"),
        )


class U256Amounts:
    """Operations on five-word amounts."""

    def _slice_sums(self, value: Column) -> list[Column]:
        top, *words = _words(value)
        slices = [top]
        for word in words:
            slices += [
                F.shiftright(word, 2 * SLICE_BITS),
                _low_bits(F.shiftright(word, SLICE_BITS), SLICE_BITS),
                _low_bits(word, SLICE_BITS),
            ]
        return [F.sum(part) for part in slices]

    def _from_slice_sums(self, sums: list[Column]) -> Column:
        slices = _carried(sums, SLICE_BITS)
        return _amount([slices[0], *(_join_bits(slices[i : i + 3], SLICE_BITS) for i in range(1, 13, 3))])

    def total(self, value: Column) -> Column:
        return self._from_slice_sums(self._slice_sums(value))

    def partial_sums(self, name: str, value: Column) -> list[Column]:
        return [part.alias(f"{name}_{i}") for i, part in enumerate(self._slice_sums(value))]

    def finish_sums(self, df: DataFrame, names: list[str]) -> DataFrame:
        slices = {name: [f"{name}_{i}" for i in range(13)] for name in names}
        others = [c for c in df.columns if not any(c in parts for parts in slices.values())]
        totals = [self._from_slice_sums([F.col(p) for p in parts]).alias(n) for n, parts in slices.items()]
        return df.select(*others, *totals)

    def positive_sum(self, name: str) -> Column:
        """Whether partial sums add up to more than 0: carrying the sum less one leaves a top slice that is not negative.

        One chain without the lower bits. A filter on the finished words would be pushed below the carry and repeat it, in
        generated methods above the 8,000 bytes that the JVM compiles.
        """
        carry = F.col(f"{name}_12") - _big(1)
        for i in range(11, -1, -1):
            carry = F.col(f"{name}_{i}") + F.shiftright(carry, SLICE_BITS)
        return carry >= 0

    def zero(self) -> Column:
        return _amount([_big(0)] * WORDS)

    def negate(self, value: Column) -> Column:
        """Negated words, left for ``total`` to carry."""
        return _amount([-word for word in _words(value)])

    def only_if(self, condition: Column, value: Column) -> Column:
        return _amount([F.when(condition, word).otherwise(_big(0)) for word in _words(value)])

    def net(self, received: Column, sent: Column, value: Column) -> Column:
        """The change one transfer makes to an account, left for ``total`` to carry."""
        into, out = self.only_if(received, value), self.only_if(sent, value)
        return _amount([a - b for a, b in zip(_words(into), _words(out))])

    def positive(self, value: Column) -> Column:
        top, *words = _words(value)
        lower = words[0].bitwiseOR(words[1]).bitwiseOR(words[2]).bitwiseOR(words[3])
        return (top > 0) | ((top == 0) & (lower > 0))

    def exceeds(self, value: Column, bound: int) -> Column:
        words = [bound >> WORD_BITS * (WORDS - 1 - i) for i in range(WORDS)]
        return value > _amount([_big(words[0]), *(_big(word % 2**WORD_BITS) for word in words[1:])])

    def to_double(self, value: Column) -> Column:
        result = None
        for place, word in enumerate(reversed(_words(value))):
            term = word.cast("double") * F.lit(2.0 ** (WORD_BITS * place))
            result = term if result is None else result + term
        return result

    def to_text(self, value: Column) -> Column:
        """Decimal digits. A BIGINT is cast; of larger amounts, 30-bit parts times powers of two add up in base 10^8, each
        sum below 2^61."""
        base, bits, limbs = 10**TEXT_GROUP, 30, 12

        def magnitude(v: Column) -> Column:
            words = [F.when(v["w0"] < 0, -word).otherwise(word) for word in _words(v)]
            return F.array(*_carried(words, WORD_BITS))

        def split(words: Column) -> Column:
            parts = []  # lowest first; the top word has no bound of 60 bits
            for i in range(WORDS - 1, -1, -1):
                parts += [_low_bits(words[i], bits), F.shiftright(words[i], bits)]
            return F.array(*parts[:-1], _low_bits(parts[-1], bits), F.shiftright(words[0], 2 * bits))

        def multiply(parts: Column) -> Column:
            sums = []
            for limb in range(limbs):
                terms = [(i, 2 ** (bits * i) // base**limb % base) for i in range(2 * WORDS + 1)]
                terms = [parts[i] * _big(factor) for i, factor in terms if factor]
                sums.append(reduce(Column.__add__, terms))
            return F.array(*sums)

        def render(sums: Column) -> Column:
            digits, carry = [], None
            for limb in range(limbs):
                number = sums[limb] if carry is None else sums[limb] + carry
                digits.insert(0, F.lpad((number % _big(base)).cast("string"), TEXT_GROUP, "0"))
                carry = F.call_function("div", number, _big(base))
            return F.ltrim(F.concat(*digits), F.lit("0"))

        def signed(v: Column) -> Column:
            digits = _bind(_bind(_bind(magnitude(v), split), multiply), render)
            small = (v["w0"].bitwiseOR(v["w1"]).bitwiseOR(v["w2"]) == 0) & (v["w3"] < 8)
            long = F.shiftleft(v["w3"], WORD_BITS).bitwiseOR(v["w4"])
            return F.when(small, long.cast("string")).otherwise(F.concat(F.when(v["w0"] < 0, "-").otherwise(""), digits))

        return _bind(value, signed)

    def summary(self, t: DataFrame, keys: list[str]) -> DataFrame:
        """Per key: ``transfer_count``, ``total_volume``, ``largest_transfer``.

        ``max`` over a struct has no mutable buffer and would sort every transfer. Grouping by the three
        upper words first (zero for amounts below 2^120, so one group per key in practice) leaves a
        DECIMAL maximum and keeps the wide step in a hash aggregate; the struct maximum sees only groups.
        """
        value = F.col("value")
        lower = (
            value["w3"].cast(T.DecimalType(19, 0)) * _decimal(2**WORD_BITS) + value["w4"].cast(T.DecimalType(19, 0))
        ).cast(DECIMAL38)
        upper = [f"w{i}" for i in range(3)]
        sums = {f"s{i}": part for i, part in enumerate(self._slice_sums(value))}
        groups = t.groupBy(*keys, *(value[w].alias(w) for w in upper)).agg(
            F.count(F.lit(1)).alias("n"),
            F.max(lower).alias("lower"),
            *(part.alias(name) for name, part in sums.items()),
        )
        highest, word = F.col("highest"), _decimal(2**WORD_BITS)
        largest = [highest[w] for w in upper] + [
            F.call_function("div", highest["lower"], word),
            highest["lower"] % word,
        ]
        merged = groups.groupBy(*keys).agg(
            F.sum("n").alias("transfer_count"),
            F.max(F.struct(*upper, "lower")).alias("highest"),
            *(F.sum(name).alias(name) for name in sums),
        )
        return merged.select(
            *keys,
            "transfer_count",
            self._from_slice_sums([F.col(name) for name in sums]).alias("total_volume"),
            _amount(largest).alias("largest_transfer"),
        )


def aggregate(
    t: DataFrame, keys: list[Column | str], measures: list[Column], totals: dict[str, str], positive: str | None = None
) -> DataFrame:
    """Group by ``keys`` (none for one row): the measures, then one exact total per entry of ``totals``, which
    maps result names to amount columns. With ``positive`` only groups whose total of that name is above 0.

    The slice sums of a 256-bit total carry in a projection above the aggregate. There the shared parts of the
    carries are evaluated once, while an aggregate's own result expressions would repeat them.
    """
    sums, kinds = [], {}
    for name, column in totals.items():
        amounts = amounts_of(t, column)
        kinds.setdefault(type(amounts), (amounts, []))[1].append(name)
        sums += amounts.partial_sums(name, F.col(column))
    result = t.groupBy(*keys).agg(*measures, *sums)
    for amounts, names in kinds.values():
        if positive in names:
            result = result.filter(amounts.positive_sum(positive))
    for amounts, names in kinds.values():
        result = amounts.finish_sums(result, names)
    return result


def amounts_of(df: DataFrame, column: str = "value") -> DecimalAmounts | U256Amounts:
    """The operations that fit the amount column of ``df``."""
    dtype = df.schema[column].dataType
    return U256Amounts() if isinstance(dtype, T.StructType) else DecimalAmounts()
