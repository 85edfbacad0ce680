"""Scalar rules on columns: filters with SQL's three-valued logic, null forms, metadata, usages, scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_filter(c: Column, op: str, value: str | int) -> Column:
    """``EQ``, ``NOT_EQ`` or ``NOT_STARTS_WITH`` a constant. A null passes none of them."""
    if op == "EQ":
        return c == F.lit(value)
    if op == "NOT_EQ":
        return c != F.lit(value)
    if op == "NOT_STARTS_WITH":
        return not_starts_with(c, value)
    raise ValueError(f"unknown filter {op}")


def not_starts_with(c: Column, prefix: str) -> Column:
    """The prefix is literal: ``%`` and ``_`` stand for themselves."""
    if not prefix:
        raise ValueError("the prefix must not be empty")
    return ~F.startswith(c, F.lit(prefix))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def millis_or_null(c: Column, sentinel: int = 0) -> Column:
    """UTC instant of epoch milliseconds; null for null and for the sentinel."""
    return F.timestamp_millis(F.nullif(c, F.lit(sentinel)))


def blank_to_null(c: Column) -> Column:
    """Null if there is nothing but spaces, else the text as it is."""
    return F.when(F.trim(c) != "", c)


def localized(names: Column, locale: str, fallback: str) -> Column:
    return F.coalesce(F.try_element_at(names, F.lit(locale)), F.try_element_at(names, F.lit(fallback)))


def localized_map(names: Column) -> Column:
    """The map, or null if all its texts are blank."""
    return F.when(F.exists(F.map_values(names), lambda v: F.trim(v) != ""), names)


def metadata(c: Column, key: str, kind: str) -> Column:
    """Typed read of an open map of strings; what can't be read is null."""
    return F.try_element_at(c, F.lit(key)).try_cast(kind)


def seller_fee(c: Column, amount_key: str = "feeAdena", percent_key: str = "feePercent") -> Column:
    """(amount, percent) of metadata; null unless amount >= 0 and percent is 0 to 50."""
    amount, percent = metadata(c, amount_key, "bigint"), metadata(c, percent_key, "int")
    return F.when((amount >= 0) & percent.between(0, 50), F.struct(amount.alias("amount"), percent.alias("percent")))


def carries_state(*volatile: Column) -> Column:
    """Whether a runtime row says anything: a row whose volatile fields are all null is a tombstone."""
    return F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in volatile], F.lit(False))


def usage_valid(used: Column, limit: Column, remaining: Column) -> Column:
    """Counts are not negative, and without a limit nothing remains."""
    sound = lambda c: c.isNull() | (c >= 0)
    return sound(used) & sound(limit) & sound(remaining) & (limit.isNotNull() | remaining.isNull())


def usage_remaining(limit: Column, used: Column) -> Column:
    """What is left, 0 at least; null without a limit."""
    return F.when(limit.isNotNull(), F.greatest(limit - F.coalesce(used, F.lit(0)), F.lit(0)))


def duplicate_usages(usages: Column) -> Column:
    """Whether an array of (type, key, ...) has two entries of one identity; a null key is an identity of its own."""
    ids = F.transform(usages, lambda u: F.struct(u["type"], u["key"].isNull(), u["key"]))
    return F.size(F.array_distinct(ids)) < F.size(ids)


def tier_multiplier(used: Column, steps: Column) -> Column:
    """Multiplier of the step with the largest ``after`` that ``used`` has reached; 1 before the first."""
    reached = F.array_max(F.filter(F.transform(steps, lambda s: F.struct(s["after"].alias("after"), s["multiplier"].alias("multiplier"))), lambda s: s["after"] <= used))
    return F.coalesce(reached["multiplier"], F.lit(1.0))


def scaling_value(level: Column, steps: Column) -> Column:
    """Value of the step whose range ``[from, to]`` holds the level; a null ``to`` is open."""
    return F.get(F.filter(steps, lambda s: (s["from"] <= level) & (s["to"].isNull() | (level <= s["to"]))), F.lit(0))["value"]


def capped(value: Column, cap: Column) -> Column:
    """``value`` up to ``cap``; a null cap doesn't limit."""
    return F.when(value.isNotNull(), F.least(value, cap))


def status_bucket(status: Column) -> Column:
    """``dead`` or ``alive``; everything that isn't dead counts as alive."""
    return F.when(status == "dead", "dead").otherwise("alive")


def auth_outcome_class(outcome: Column, success: tuple[str, ...] = ("success",), failure: tuple[str, ...] = ("wrong_password", "no_account", "banned")) -> Column:
    """``success``, ``failure`` or, for a value that no list has, null."""
    return F.when(outcome.isin(*success), "success").when(outcome.isin(*failure), "failure")


def prefer_canonical_class(clazz: Column, class_id: Column) -> Column:
    return F.coalesce(clazz, class_id.cast("string"))


def ban_active(expires_at: Column, now: Column) -> Column:
    """A ban without an end is permanent."""
    return expires_at.isNull() | (expires_at > now)


def active_cooldowns(cooldowns: Column, now: Column) -> Column:
    """Entries that still hold; a null list, which means not synced, stays null."""
    return F.filter(cooldowns, lambda c: c["reentry_at"] > now)
