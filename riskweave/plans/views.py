"""The data views once more, as SQL for the oracle engine (see FIXTURES.md)."""

from __future__ import annotations

VIEWS = """
b as (
  select event_id, ts, user_id, event_type, value,
         cast(json_extract_string(props, '$.k') as bigint) as k,
         cast(floor(epoch(ts)) as bigint) as es
  from events),
txn as (
  select event_id as TransactionID,
    case when event_type = 'error' then 1 else 0 end as isFraud,
    86400 + es - 1704067200 as TransactionDT, value as TransactionAmt,
    substring('WCRHS', cast(k % 5 + 1 as int), 1) as ProductCD, user_id as card1,
    case when k % 10 = 9 then null else concat('net', cast(k % 4 as string)) end as card4,
    case when k % 2 = 0 then 'debit' else 'credit' end as card6,
    concat('dom', cast(k % 20 as string)) as P_emaildomain,
    case when k % 3 = 0 then null else concat('dom', cast(k % 7 as string)) end as R_emaildomain,
    case when event_id % 10 = 0 then null else cast(100 + user_id % 40 as double) end as addr1,
    cast(row_number() over (partition by user_id order by ts, event_id) as double) as C13,
    cast(floor((es - lag(es) over (partition by user_id order by ts, event_id)) / 3600)
         as double) as D1,
    case when k % 4 = 0 then null else cast(k as double) end as D4,
    case when k % 5 = 0 then null else cast(floor(value) as double) end as D10,
    case when event_id % 2 = 0 then null else value * 2 end as V1,
    cast(null as double) as V2, value / 2 as V3
  from b),
identity as (
  select TransactionID, cast(card1 as string) as id_01,
    case when TransactionID % 8 = 0 then 'Found' else 'NotFound' end as id_12,
    case when card6 = 'debit' then 'mobile' else 'desktop' end as DeviceType
  from txn where TransactionID % 4 = 0),
pred_log as (
  select md5(cast(event_id as string)) as prediction_id, ts as "timestamp",
    round(value / (value + 50), 6) as fraud_probability,
    case when value / (value + 50) >= 0.5 then 1 else 0 end as prediction,
    cast(0.5 as double) as threshold_used, value * 10 as latency_ms, 'm1' as model_version
  from events),
scored as (
  select TransactionID, TransactionDT, ProductCD, card6, isFraud as y,
         TransactionAmt / (TransactionAmt + 50) as score
  from txn),
learn as (
  select * exclude (isFraud),
    case when coalesce(TransactionAmt, 0) + coalesce(D4, 0) > 160 then 1 else 0 end as isFraud
  from txn),
ranked as (
  select *, row_number() over (order by TransactionDT, TransactionID) - 1 as rk,
         count(*) over () as total
  from txn)
"""

TXN_COLUMNS = [
    "TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card4",
    "card6", "P_emaildomain", "R_emaildomain", "addr1", "C13", "D1", "D4", "D10", "V1", "V2", "V3",
]
TXN_DOUBLES = ["TransactionAmt", "addr1", "C13", "D1", "D4", "D10", "V1", "V2", "V3"]


def sql(body: str, extra: str = "") -> str:
    """A statement over the views, with further common tables in ``extra``."""
    return f"with {VIEWS}{', ' + extra if extra else ''}\n{body}"


def r(e: str) -> str:
    return f"(floor(round({e}, 9) * 1e6 + 0.5) / 1e6)"


def cols(names: list[str], prefix: str = "") -> str:
    """Columns, doubles rounded."""
    return ", ".join(
        f"{r(prefix + c)} as {c}" if c in TXN_DOUBLES else f"{prefix}{c}" for c in names
    )


def big(e: str) -> str:
    return f"cast({e} as bigint)"
