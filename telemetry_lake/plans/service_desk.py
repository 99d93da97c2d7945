"""Ticket reports. All take tickets from which ignored ones were already removed
(:func:`telemetry_lake.operators.joins.without_tagged`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import days, format_days, round_half_down
from ..functions.times import elapsed_seconds, year_week
from ..operators.joins import with_key_in
from ..schemas import TICKET_PRIORITIES

LAST_N = (15, 50, 200)


def _closed() -> Column:
    return F.col("Status") == "closed"


def _rma() -> Column:
    return F.col("Type") == "rma"


def _seconds() -> Column:
    return elapsed_seconds(F.col("CreatedOn"), F.col("ModifiedOn"))


def _days() -> Column:
    return days(_seconds())


def status_priority(tickets: DataFrame) -> DataFrame:
    """Tickets per status and priority; a missing priority counts as normal. The four usual
    priorities have a column each, and so has any other that occurs."""
    named = tickets.select("Status", "Priority").fillna("normal", ["Priority"])
    others = named.filter(~F.col("Priority").isin(*TICKET_PRIORITIES)).select("Priority").distinct()
    columns = [*TICKET_PRIORITIES, *sorted(r["Priority"] for r in others.collect())]
    return named.groupBy("Status").pivot("Priority", columns).count().fillna(0, columns)


def last_created(tickets: DataFrame, n: int = 20) -> DataFrame:
    newest = tickets.orderBy(F.desc("CreatedOn"), F.desc("Number")).limit(n)
    return newest.select("Number", "Priority", "Subject", "CreatedOn")


def last_closed(tickets: DataFrame, n: int = 20) -> DataFrame:
    newest = tickets.filter(_closed() & ~_rma()).orderBy(F.desc("ModifiedOn"), F.desc("Number")).limit(n)
    return newest.select("Number", "Priority", "Subject", _days().alias("ResolutionTime_Days"))


def work_in_progress(tickets: DataFrame) -> DataFrame:
    open_tickets = tickets.filter(F.col("Status") != "closed").orderBy(F.desc("Number"))
    return open_tickets.select("Number", "Priority", "Status", "Subject", "Type", "CreatedOn")


def customer_accounts(accounts: DataFrame, excluded: str) -> DataFrame:
    """Accounts whose name does not match ``excluded``; nameless ones drop out as well."""
    return accounts.filter(~F.col("Name").rlike(excluded))


def resolution_by_account(tickets: DataFrame, accounts: DataFrame, excluded: str) -> DataFrame:
    """Total days from creation to last change per account, longest first."""
    totals = tickets.groupBy("AccountId").agg(F.sum(_days()).alias("Total Days"))
    named = customer_accounts(accounts, excluded).select(F.col("Id").alias("AccountId"), "Name")
    return totals.join(named, "AccountId").select("AccountId", "Name", "Total Days").orderBy(F.desc("Total Days"), "AccountId")


def _named(accounts: DataFrame, excluded: str) -> DataFrame:
    return customer_accounts(accounts, excluded).select(
        F.col("Id").alias("AccountId"), F.col("Name").alias("AccountName")
    )


def tickets_by_account(tickets: DataFrame, accounts: DataFrame, excluded: str) -> DataFrame:
    """Every ticket with its account and its age in days as text, newest number first."""
    return (
        tickets.join(_named(accounts, excluded), "AccountId")
        .select("AccountId", "AccountName", "Number", format_days(_seconds()).alias("Days"), "Subject")
        .orderBy(F.desc("Number"))
    )


def account_list(tickets: DataFrame, accounts: DataFrame, excluded: str) -> DataFrame:
    """Accounts that have tickets, by name.

    A semi-join on the account ids: a busy account shrinks to one row before the shuffle.
    """
    listed = with_key_in(_named(accounts, excluded), tickets, "AccountId").distinct()
    return listed.orderBy("AccountName", "AccountId")


def _open_counts() -> list[Column]:
    """Open tickets in all and by severity: urgent, high, and everything else."""
    is_open = F.col("Status") != "closed"
    urgent = F.coalesce(F.col("Priority") == "urgent", F.lit(False))
    high = F.coalesce(F.col("Priority") == "high", F.lit(False))
    return [
        F.count_if(is_open).alias("All"),
        F.count_if(is_open & urgent).alias("SeverityLevel1"),
        F.count_if(is_open & high).alias("SeverityLevel2"),
        F.count_if(is_open & ~urgent & ~high).alias("SeverityLevel3"),
    ]


def open_by_severity(tickets: DataFrame) -> DataFrame:
    return tickets.agg(*_open_counts())


def closed_by_week(tickets: DataFrame) -> DataFrame:
    """Closed tickets per calendar year and ISO week, as the report pairs them."""
    year, week = F.year("ModifiedOn").alias("Year"), F.weekofyear("ModifiedOn").alias("Week")
    counted = tickets.filter(_closed()).groupBy(year, week).agg(F.count("Number").alias("count"))
    return counted.withColumn("Year-Week", year_week(F.col("Year"), F.col("Week"))).orderBy("Year", "Week")


def closed_by_month(tickets: DataFrame) -> DataFrame:
    year, month = F.year("ModifiedOn").alias("Year"), F.month("ModifiedOn").alias("Month")
    counted = tickets.filter(_closed()).groupBy(year, month).agg(F.count("Number").alias("count"))
    return counted.withColumn("Year-Month", year_week(F.col("Year"), F.col("Month"))).orderBy("Year", "Month")


def closed_last_two_weeks(tickets: DataFrame) -> DataFrame:
    """Counts of the two latest weeks that have any, in one row; null where there is none."""
    latest = closed_by_week(tickets).orderBy(F.desc("Year"), F.desc("Week")).limit(2)
    ordered = F.sort_array(F.collect_list(F.struct("Year", "Week", "count")), asc=False)
    return latest.agg(ordered.alias("w")).select(
        F.get("w", F.lit(0))["count"].alias("CurrentWeek"), F.get("w", F.lit(1))["count"].alias("PrevWeek")
    )


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(values))


def _closed_tickets(tickets: DataFrame, rma: bool) -> DataFrame:
    return tickets.filter(_closed() & (_rma() if rma else ~_rma())).select("ModifiedOn", "Number", _days().alias("days"))


def _latest_days(closed: DataFrame, n: int) -> DataFrame:
    """Days of the ``n`` tickets closed last, newest first, as one array."""
    newest = closed.orderBy(F.desc("ModifiedOn"), F.desc("Number")).limit(n)
    listed = F.sort_array(F.collect_list(F.struct("ModifiedOn", "Number", "days")), asc=False)
    return newest.agg(listed["days"].alias("d"))


def _resolution_columns(mean: Column, latest: Column, last: Sequence[int]) -> list[Column]:
    return [
        round_half_down(mean).alias("All"),
        *[round_half_down(_mean(F.slice(latest, 1, n))).alias(f"Last#{n}") for n in last],
    ]


def average_resolution(tickets: DataFrame, rma: bool = False, last: Sequence[int] = LAST_N) -> DataFrame:
    """Mean days to close over all closed tickets and over the latest ``last`` ones, in one row.

    The latest ones are taken by a top-n of the largest ``n``; the shorter ranges are cut from
    that list.
    """
    closed = _closed_tickets(tickets, rma)
    overall = closed.agg(F.avg("days").alias("mean"))
    both = overall.select("mean", _latest_days(closed, max(last)).scalar().alias("d"))
    return both.select(*_resolution_columns(F.col("mean"), F.col("d"), last))


def ticket_stats(tickets: DataFrame, last: Sequence[int] = LAST_N) -> DataFrame:
    """One row of four maps: open, closed, and resolution times without and for returns.

    One pass per week of the last change covers the counts and overall means; each of the two
    latest-n lists takes a top-n of its own.
    """
    returned, kept = _closed() & _rma(), _closed() & ~_rma()
    weekly = tickets.groupBy(
        F.when(_closed(), F.year("ModifiedOn")).alias("Year"), F.when(_closed(), F.weekofyear("ModifiedOn")).alias("Week")
    ).agg(
        *_open_counts(),
        F.count(F.when(_closed(), F.col("Number"))).alias("closed"),
        F.sum(F.when(kept, _days())).alias("days"),
        F.count(F.when(kept, _days())).alias("n"),
        F.sum(F.when(returned, _days())).alias("rma_days"),
        F.count(F.when(returned, _days())).alias("rma_n"),
    )
    levels = ["All", "SeverityLevel1", "SeverityLevel2", "SeverityLevel3"]
    week = F.when(F.col("Year").isNotNull(), F.struct("Year", "Week", "closed"))
    totals = weekly.agg(
        *[F.sum(c).alias(c) for c in levels],
        F.sort_array(F.collect_list(week), asc=False).alias("weeks"),
        F.try_divide(F.sum("days"), F.sum("n")).alias("mean"),
        F.try_divide(F.sum("rma_days"), F.sum("rma_n")).alias("rma_mean"),
    )
    row = totals.select(
        "*",
        _latest_days(_closed_tickets(tickets, rma=False), max(last)).scalar().alias("latest"),
        _latest_days(_closed_tickets(tickets, rma=True), max(last)).scalar().alias("rma_latest"),
    )

    def as_map(entries: dict[str, Column]) -> Column:
        return F.create_map(*[part for name, value in entries.items() for part in (F.lit(name), value)])

    def times(mean: str, latest: str) -> Column:
        names = ["All", *[f"Last#{n}" for n in last]]
        return as_map(dict(zip(names, _resolution_columns(F.col(mean), F.col(latest), last))))

    return row.select(
        as_map({c: F.coalesce(F.col(c), F.lit(0)) for c in levels}).alias("Open"),
        as_map(
            {"CurrentWeek": F.get("weeks", F.lit(0))["closed"], "PrevWeek": F.get("weeks", F.lit(1))["closed"]}
        ).alias("Closed"),
        times("mean", "latest").alias("ResolutionTime"),
        times("rma_mean", "rma_latest").alias("RMAResolutionTime"),
    )
