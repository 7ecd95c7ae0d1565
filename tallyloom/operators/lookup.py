"""Joins and lookups J1-J15.

No broadcast hints: Spark broadcasts a side only below its size threshold
(checked at planning and again at run time by AQE) and otherwise shuffles, where
AQE splits skewed partitions. ``salted_lookup`` is there for a large dimension
that meets a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import placeholder_name
from tallyloom.operators.columns import ref, require
from tallyloom.operators.dedupe import deduplicate, top_k
from tallyloom.operators.skew import SALTS, row_salt, spread_join

# --- Fixed values -----------------------------------------------------------
DEFAULT_COMPANY = 1
ACCOUNT_PREFIX = "act_"
SENIORITY = {
    "1": "Unpaid",
    "2": "Training",
    "3": "Entry level",
    "4": "Senior",
    "5": "Manager",
    "6": "Director",
    "7": "VP",
    "8": "CXO",
    "9": "Partner",
    "10": "Owner",
}
SHARE_COUNTS = {
    "impressionCount": "impression_count",
    "uniqueImpressionsCount": "unique_impression_count",
    "clickCount": "click_count",
    "likeCount": "like_count",
    "commentCount": "comment_count",
    "shareCount": "share_count",
    "engagement": "engagement",
}
# ----------------------------------------------------------------------------


def key_side(df: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Distinct keys under private names, so a table can meet a slice of itself.

    ``unique`` says the table holds each key once, as loaded tables do. The
    distinct is then left out: it would not shrink anything, and with a bare
    shuffle on this side AQE can split a hot key of the other side.
    """
    side = df.select(*[ref(k).alias(f"__t_{k}") for k in keys])
    return side if unique else side.distinct()


def same_key(keys: Sequence[str], null_safe: bool = True) -> Column:
    """Equality of the keys with those of :func:`key_side`."""
    pairs = [(ref(k), ref(f"__t_{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])


def anti_existing(
    new: DataFrame, target: DataFrame, keys: Sequence[str], date_key: str | None = None, unique: bool = False
) -> DataFrame:
    """Rows whose key the target does not hold.

    With ``date_key`` in the key the target scan is cut to the days of the batch
    (trap T6: never when the date is not part of the key).
    """
    require(new, keys, "anti_existing")
    if date_key is not None:
        if date_key not in keys:
            raise ValueError("date_key must be one of the keys")
        span = new.agg(F.min(ref(date_key)).alias("lo"), F.max(ref(date_key)).alias("hi"))
        target = target.filter(ref(date_key).between(span.select("lo").scalar(), span.select("hi").scalar()))
    return new.join(key_side(target, keys, unique), same_key(keys), "left_anti")


def mark_existing(
    new: DataFrame, target: DataFrame, keys: Sequence[str], flag: str = "is_existing", unique: bool = False
) -> DataFrame:
    """Each row with whether the target holds its key; one plan serves both halves."""
    hits = key_side(target, keys, unique).withColumn("__hit", F.lit(True))
    joined = new.join(hits, same_key(keys), "left")
    return joined.select(*map(ref, new.columns), F.col("__hit").isNotNull().alias(flag))


def semi_recent(campaigns: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Campaigns that have a link; links are cut to distinct keys inside the tasks that read them."""
    return campaigns.join(links.select(ref(key)).distinct(), key, "left_semi")


def render_campaigns(
    renders: DataFrame, campaigns: DataFrame, message: str, external: str, contact: str, campaign_id: str
) -> DataFrame:
    """Message and greatest contact of renders that belong to a campaign.

    The log is aggregated before the join, so a campaign that fills a third of
    it joins as one row per message; the distinct campaign ids keep it a semi join.
    """
    per_message = renders.groupBy(ref(message), ref(external)).agg(F.max(ref(contact)).alias("contact_id"))
    known = campaigns.select(ref(campaign_id).alias(external))
    return per_message.join(known, external, "left_semi")


def split_key_join(mails: DataFrame, campaigns: DataFrame, companies: DataFrame, code: str, campaign_code: str, campaign_id: str) -> DataFrame:
    """E-mails ⋈ campaigns on the code before the dot ⋈ companies; the dimensions meet first, the e-mails join once."""
    known = campaigns.select(ref(campaign_code).alias("__code"))
    owners = companies.withColumnRenamed(campaign_id, "__code").join(known, "__code", "left_semi")
    keyed = mails.withColumn("__code", F.split_part(ref(code), F.lit("."), F.lit(1)))
    return spread_join(keyed, owners, ["__code"]).drop("__code")


def post_insights(posts: DataFrame, stats: DataFrame, order: str) -> DataFrame:
    """Posts ⟕ share statistics by post URN; last duplicate wins, missing counts are 0."""
    urn = F.coalesce(F.nullif(F.col("share"), F.lit("")), F.col("ugcPost")).alias("__urn")
    keyed = stats.select(urn, ref(order), "totalShareStatistics").filter(F.col("__urn").isNotNull())
    last = deduplicate(keyed, ["__urn"], [order], "last")
    counts = [
        F.coalesce(F.col(f"totalShareStatistics.{src}"), F.lit(0)).alias(dst) for src, dst in SHARE_COUNTS.items()
    ]
    joined = posts.join(last.select("__urn", "totalShareStatistics"), F.col("id") == F.col("__urn"), "left")
    base = list(map(ref, posts.columns))
    zeros = [F.lit(0).cast("bigint").alias(n) for n in ("video_views", "video_view_time_ms")]
    return joined.select(*base, *counts, *zeros)


def lookup(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], value: str, out: str, default: Column | None = None
) -> DataFrame:
    """One value from a dimension unique on its key; ``default`` where there is none."""
    side = dim.select(*[ref(d).alias(f"__k{i}") for i, d in enumerate(on.values())], ref(value).alias("__v"))
    cond = reduce(lambda a, b: a & b, [ref(c) == F.col(f"__k{i}") for i, c in enumerate(on)])
    got = F.col("__v") if default is None else F.coalesce(F.col("__v"), default)
    keep = [c for c in df.columns if c != out]
    return df.join(side, cond, "left").select(*map(ref, keep), got.alias(out))


def salted_lookup(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str, salts: int = SALTS, hot: Sequence = ()
) -> DataFrame:
    """As :func:`lookup` for a dimension too large to broadcast and keys known to be hot.

    Rows of hot keys spread over ``salts`` partitions by a hash of the whole row
    (repeatable when a task runs again); only the hot dimension rows are copied.
    """
    is_hot = ref(key).isin(*hot) if hot else F.lit(False)
    salt = F.when(is_hot, row_salt(df, salts)).otherwise(F.lit(0))
    copies = F.when(ref(dim_key).isin(*hot) if hot else F.lit(False), F.sequence(F.lit(0), F.lit(salts - 1)))
    side = dim.select(ref(dim_key).alias("__k"), ref(value).alias(out), F.explode(F.coalesce(copies, F.array(F.lit(0)))).alias("__s"))
    joined = df.withColumn("__salt", salt).join(side, (ref(key) == F.col("__k")) & (F.col("__salt") == F.col("__s")), "left")
    return joined.drop("__k", "__s", "__salt")


def add_company(
    df: DataFrame, companies: DataFrame, account: str, default: int = DEFAULT_COMPANY, out: str = "companyid"
) -> DataFrame:
    """Company of an account; the bare id answers when the prefixed one does not; default otherwise.

    ``companies`` holds account_id and company_id, unique on account_id.
    """
    bare = df.withColumn("__bare", F.replace(ref(account).cast("string"), F.lit(ACCOUNT_PREFIX), F.lit("")))
    exact = lookup(bare, companies, {account: "account_id"}, "company_id", "__exact")
    both = lookup(exact, companies, {"__bare": "account_id"}, "company_id", "__loose")
    value = F.coalesce(F.col("__exact"), F.col("__loose"), F.lit(default))
    return both.select(*map(ref, df.columns), value.alias(out))


def lookup_names(df: DataFrame, names: DataFrame, id_col: str, name_col: str, label: str) -> DataFrame:
    """Name of an id, else ``<label> <id>``; null id gives null. ``names`` holds id and name."""
    return lookup(df, names, {id_col: "id"}, "name", name_col, placeholder_name(label, ref(id_col)))


def localized_name(names: Column, locale: str = "en_US") -> Column:
    """The wanted locale, else the first value of the map."""
    return F.coalesce(names[locale], F.get(F.map_values(names), F.lit(0)))


def seniority_name(code: Column) -> Column:
    """Ten fixed codes, bare or as URN; anything else null."""
    table = F.create_map(*[F.lit(x) for pair in SENIORITY.items() for x in pair])
    return F.try_element_at(table, F.regexp_replace(code.cast("string"), r"^urn:li:seniority:", ""))


def unmapped_codes(df: DataFrame, code: str) -> DataFrame:
    """Codes without a name."""
    return df.filter(ref(code).isNotNull() & seniority_name(ref(code)).isNull()).select(ref(code)).distinct()


def first_success(candidates: DataFrame, previews: DataFrame, keys: Sequence[str], group: str, rank: str, failed: str | None = None) -> DataFrame:
    """Per group the best-ranked candidate that has a preview.

    A candidate without a preview is passed over. With ``failed`` (a boolean
    preview column for errors other than not-found) the search stops at the
    first failure: groups whose failure ranks before their first hit give no row.
    """
    joined = candidates.join(previews, list(keys))
    rest = [c for c in joined.columns if c != group]
    best = F.min_by(F.struct(*map(ref, rest)), ref(rank)).alias("__best")
    picked = joined.groupBy(ref(group)).agg(best).select(ref(group), *[F.col("__best").getField(c).alias(c) for c in rest])
    return picked.filter(~F.coalesce(ref(failed), F.lit(False))) if failed else picked


def first_success_ranked(joined: DataFrame, group: str, rank: str, hit: Column) -> DataFrame:
    """First row by rank among hits."""
    return top_k(joined.filter(hit), [group], [ref(rank).asc_nulls_last()], 1)


def enrich_or_keep(df: DataFrame, found: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Take found values, keep the row's own where the lookup has none."""
    side = found.select(*map(ref, keys), *[ref(c).alias(f"__new_{c}") for c in cols])
    joined = df.join(side, list(keys), "left")
    return joined.select(
        *[(F.coalesce(F.col(f"__new_{c}"), ref(c)) if c in cols else ref(c)).alias(c) for c in df.columns]
    )


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold at least ``share`` of all rows: at most ``1 / share`` values, so safe to bring to the driver.

    One pass of partial counts.
    """
    counts = df.groupBy(ref(key)).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return [r[0] for r in counts.filter((F.col("__n") >= total * share) & ref(key).isNotNull()).select(ref(key)).collect()]
