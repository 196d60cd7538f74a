"""Feature flags as a rule table.

A rule names a flag, a context kind and a context key (null: every context of the kind), whether it
is enabled, and optionally a rollout in basis points. A rule for the context itself comes before the
rule for all; without any rule, or offline, the default holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.functions.text import has_text
from keyflow.operators.skew import HEAVY_FLOOR, SALTS, frequent_keys, lookup_join

MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class FlagSettings:
    enabled: bool = True
    sdk_key: str | None = None
    offline: bool = False

    def effective_offline(self) -> bool:
        """Offline when asked for, when disabled, or while the key is still the placeholder."""
        unset = not (self.sdk_key or "").strip() or self.sdk_key == S.PLACEHOLDER_SDK_KEY
        return self.offline or not self.enabled or unset


def effective_offline(enabled: Column, sdk_key: Column, offline: Column) -> Column:
    """The same rule over columns."""
    unset = ~has_text(sdk_key) | (sdk_key == S.PLACEHOLDER_SDK_KEY)
    return offline | ~enabled | unset


def customer_context(customer_id: Column) -> Column:
    return F.when(has_text(customer_id), customer_id).otherwise(F.lit(S.ANONYMOUS))


def rollout_bucket(flag: str, context_key: Column) -> Column:
    """A stable bucket of 0 to 9999 for a flag and a context."""
    digest = F.md5(F.concat(F.lit(flag + "."), context_key).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000


def _value(enabled: Column, rollout_bp: Column, bucket: Column) -> Column:
    return enabled & F.coalesce(bucket < rollout_bp.cast("int"), F.lit(True))


def _rules(rules: DataFrame, flag: str, kind: str) -> DataFrame:
    """One rule per context key; of several, the strictest."""
    own = rules.filter((F.col("flag_key") == flag) & (F.col("context_kind") == kind))
    merged = own.groupBy("context_key").agg(
        F.bool_and("enabled").alias("enabled"), F.min("rollout_bp").alias("rollout_bp")
    )
    return merged.select("context_key", F.struct("enabled", "rollout_bp").alias("_rule"))


def with_flag(
    rows: DataFrame,
    rules: DataFrame,
    flag: str,
    default: bool,
    context_key: Column,
    kind: str = S.CUSTOMER_CONTEXT,
    settings: FlagSettings | None = None,
    name: str = "flag_enabled",
    max_broadcast: int = MAX_BROADCAST_RULES,
) -> DataFrame:
    """Add the flag's value for each row's context.

    Rules are broadcast only after counting them; a larger rule table goes through the skew-safe
    lookup join.
    """
    if settings is not None and settings.effective_offline():
        return rows.withColumn(name, F.lit(default))
    merged = _rules(rules, flag, kind)
    # one number and at most one rule for all contexts reach the driver
    rule_for_all = F.max(F.when(F.col("context_key").isNull(), F.col("_rule")))
    count, general = merged.agg(F.count("context_key"), rule_for_all).first()
    explicit = merged.filter(F.col("context_key").isNotNull()).withColumnRenamed("context_key", "_ctx")
    keyed = rows.withColumn("_ctx", context_key)
    if count <= max_broadcast:
        joined = keyed.join(F.broadcast(explicit), "_ctx", "left")
    else:
        joined = lookup_join(keyed, explicit, "_ctx")
    bucket = rollout_bucket(flag, F.col("_ctx"))
    fallback = F.lit(default)
    if general is not None:
        fallback = _value(F.lit(general["enabled"]), F.lit(general["rollout_bp"]), bucket)
    rule = F.col("_rule")
    own = F.when(rule.isNotNull(), _value(rule["enabled"], rule["rollout_bp"], bucket))
    return joined.withColumn(name, F.coalesce(own, fallback)).drop("_ctx", "_rule")


def customer_flag(rows: DataFrame, rules: DataFrame, flag: str, default: bool, **options) -> DataFrame:
    """Flag per customer; a blank id counts as the anonymous customer."""
    context = customer_context(F.col("event.customerId"))
    return with_flag(rows, rules, flag, default, context, S.CUSTOMER_CONTEXT, **options)


def _versions(history: DataFrame, flag: str, kind: str) -> DataFrame:
    """One version per context and instant (of several, the strictest); without ``enabled`` the rule ends there."""
    own = history.filter((F.col("flag_key") == flag) & (F.col("context_kind") == kind) & F.col("valid_from").isNotNull())
    ended = F.max(F.col("enabled").isNull())
    version = F.struct(F.unix_micros("valid_from").alias("us"), F.when(~ended, F.bool_and("enabled")).alias("enabled"), F.min("rollout_bp").alias("rollout_bp"))
    return own.groupBy("context_key", "valid_from").agg(version.alias("_version")).select(F.col("context_key").alias("_ctx"), "_version")


def _version_at(versions: Column, us: Column) -> Column:
    """The last version that holds at an instant, of versions in order of time."""
    return F.try_element_at(F.filter(versions, lambda version: version["us"] <= us), F.lit(-1))


def _last_version(rows: DataFrame, versions: DataFrame, floor: int) -> DataFrame:
    """Rows with the last version of their context at ``_us``, by one sort of rows and versions along time.

    A context with more than ``floor`` rows is salted: its versions go to every salt, its rows to one of them.
    """
    heavy = frequent_keys(rows, "_ctx", floor)
    salted, everywhere = rows.withColumn("_salt", F.lit(0)), versions.withColumn("_salt", F.lit(0))
    if heavy is not None:
        marked = F.broadcast(heavy.withColumn("_heavy", F.lit(True)))
        spread = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in rows.columns]), F.lit(SALTS)).cast("int")
        salted = rows.join(marked, "_ctx", "left").withColumn("_salt", F.when(F.col("_heavy"), spread).otherwise(0)).drop("_heavy")
        salts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        everywhere = versions.join(marked, "_ctx", "left").withColumn("_salt", F.explode(salts)).drop("_heavy")
    everywhere = everywhere.withColumns({"_us": F.col("_version.us"), "_is_row": F.lit(False)})
    both = salted.withColumn("_is_row", F.lit(True)).unionByName(everywhere, allowMissingColumns=True)
    past = Window.partitionBy("_ctx", "_salt").orderBy(F.asc_nulls_first("_us"), "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_version", F.last("_version", ignorenulls=True).over(past)).filter("_is_row")
    return found.drop("_is_row", "_salt")


def with_flag_at(
    rows: DataFrame,
    history: DataFrame,
    flag: str,
    default: bool,
    context_key: Column,
    at: Column,
    kind: str = S.CUSTOMER_CONTEXT,
    settings: FlagSettings | None = None,
    name: str = "flag_enabled",
    max_broadcast: int = MAX_BROADCAST_RULES,
    floor: int = HEAVY_FLOOR,
) -> DataFrame:
    """Add the flag's value as it was at the instant ``at`` of each row.

    ``history`` is a rule table with ``valid_from``: a version holds until the next one of its context, and one without
    ``enabled`` ends the rule. Then the rule for all contexts holds, in its version of that instant, and without one the
    default; so it does for rows without instant. Versions are broadcast after counting them; a longer history
    meets the rows in one sort along time, with hot contexts salted. Of the rule for all, ``max_broadcast`` versions
    are taken at most; more are an error.
    """
    if settings is not None and settings.effective_offline():
        return rows.withColumn(name, F.lit(default))
    versions = _versions(history, flag, kind)
    of_all = F.col("_ctx").isNull()
    count, of_general = versions.agg(F.count("_ctx"), F.count_if(of_all)).first()
    if of_general > max(max_broadcast, MAX_BROADCAST_RULES):
        raise ValueError("too many versions of one rule")
    general = sorted(row["_version"] for row in versions.filter(of_all).collect())
    keyed = rows.withColumns({"_ctx": context_key, "_us": F.unix_micros(at)})
    own = versions.filter(~of_all)
    if count <= max_broadcast:
        lists = own.groupBy("_ctx").agg(F.sort_array(F.collect_list("_version")).alias("_versions"))
        found = keyed.join(F.broadcast(lists), "_ctx", "left").withColumn("_version", _version_at(F.col("_versions"), F.col("_us"))).drop("_versions")
    else:
        found = _last_version(keyed, own, floor)
    bucket = rollout_bucket(flag, F.col("_ctx"))
    value = F.lit(default)
    for version in general:
        holds = F.lit(default)
        if version["enabled"] is not None:
            holds = _value(F.lit(version["enabled"]), F.lit(version["rollout_bp"]), bucket)
        value = F.when(F.col("_us") >= version["us"], holds).otherwise(value)
    version = F.col("_version")
    valued = F.when(version["enabled"].isNotNull(), _value(version["enabled"], version["rollout_bp"], bucket)).otherwise(value)
    return found.withColumn(name, valued).drop("_ctx", "_us", "_version")


def customer_flag_at(rows: DataFrame, history: DataFrame, flag: str, default: bool, **options) -> DataFrame:
    """Flag per customer as of the record's arrival."""
    context = customer_context(F.col("event.customerId"))
    return with_flag_at(rows, history, flag, default, context, F.col("arrival_ts"), **options)


def application_flag(
    rows: DataFrame,
    rules: DataFrame,
    flag: str,
    default: bool,
    application: str,
    settings: FlagSettings | None = None,
    name: str = "flag_enabled",
) -> DataFrame:
    """Flag for the whole application: the same value on every row, so a literal and no join."""
    value = F.lit(default)
    if settings is None or not settings.effective_offline():
        key = F.col("context_key")
        merged = _rules(rules, flag, S.APPLICATION_CONTEXT).filter(key.isNull() | (key == application))
        # one row for the application and one for all at most
        found = merged.agg(*(F.max(F.when(which, F.col("_rule"))) for which in (key == application, key.isNull()))).first()
        rule = found[0] or found[1]
        if rule is not None:
            value = _value(F.lit(rule["enabled"]), F.lit(rule["rollout_bp"]), rollout_bucket(flag, F.lit(application)))
    return rows.withColumn(name, F.coalesce(value, F.lit(default)))
