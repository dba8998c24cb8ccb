"""Small text and number rules used by reports and log cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from embedlift.model import MIGRATION_STATES, PROFILES, RPC_CODES

MASK = "****"


def mask_secret(secret: Column, keep_last: int = 4) -> Column:
    """Hide everything but the last ``keep_last`` characters."""
    return (F.when(F.length(secret) <= keep_last, F.lit(MASK))
            .otherwise(F.concat(F.lit(MASK), F.right(secret, F.lit(keep_last)))))


def mask_api_key(key: Column) -> Column:
    """Show the first and last four characters of keys longer than eight."""
    shown = F.concat(F.left(key, F.lit(4)), F.lit("..."), F.right(key, F.lit(4)))
    return F.when(F.length(key) <= 8, F.lit(MASK)).otherwise(shown)


def percentage(part: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(part / total * 100)


def bearer_key(header: Column) -> Column:
    """The key behind ``Bearer `` (exact case, something must follow), else the header as it is."""
    return (F.when(header.startswith("Bearer ") & (F.length(header) > 7), F.substring(header, 8, 2147483647))
            .otherwise(header))


def rfc3339(ts: Column) -> Column:
    """UTC time text of a TIMESTAMP, or of a TIMESTAMP_NTZ that is in UTC, in any session zone."""
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(ts.cast("timestamp")).cast("decimal(18,6)"))
    utc = F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("timestamp_ntz")).otherwise(F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + since)
    return F.concat(F.replace(F.substring(utc.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("Z"))


def parse_rfc3339(text: Column) -> Column:
    """NULL where the text is no time."""
    return F.try_to_timestamp(text)


def same_name(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def valid_status(status: Column) -> Column:
    return F.lower(status).isin(*MIGRATION_STATES)


def valid_database_type(name: Column, allowed: tuple[str, ...] = tuple(PROFILES)) -> Column:
    return name.isin(*allowed)


def rpc_outcome(request: Column, known_methods: tuple[str, ...], api_key: Column, known_key: Column,
                limited: Column) -> Column:
    """Error code a logged request leads to, 0 when it succeeds.

    Access checks come first (missing key, unknown key, rate), then the body:
    unreadable JSON, wrong protocol version, unknown method.
    """
    body = F.try_parse_json(request)
    version = F.try_variant_get(body, "$.jsonrpc", "string")
    method = F.try_variant_get(body, "$.method", "string")
    known = method.isin(*known_methods) if known_methods else F.lit(False)
    return (F.when(api_key.isNull() | (api_key == ""), RPC_CODES["missing_authorization"])
            .when(~known_key, RPC_CODES["invalid_api_key"])
            .when(limited, RPC_CODES["rate_limited"])
            .when(body.isNull(), RPC_CODES["parse_error"])
            .when(F.coalesce(version, F.lit("")) != "2.0", RPC_CODES["invalid_request"])
            .when(~F.coalesce(known, F.lit(False)), RPC_CODES["internal_error"])
            .otherwise(0).cast("int"))
