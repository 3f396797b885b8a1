"""Rows as the serving side hands them out: of one tenant, of one client, in a fixed order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So many clients of a tenant are sent to all tasks; more are joined by a shuffle.
FEW = 1_000_000


def ordered(rows: DataFrame, *keys: str) -> DataFrame:
    """Sorted by the keys; one that begins with "-" runs downwards."""
    return rows.orderBy(*(F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys))


def of_client(rows: DataFrame, client: int, *keys: str) -> DataFrame:
    """One client's rows, in order."""
    return ordered(rows.where(F.col("client_id") == client), *keys)


def clients_of(tenants: DataFrame, tenant: int) -> DataFrame:
    """(client_id) of a tenant; a tenant that nobody has heard of is an error. tenants: client_id, tenant_id."""
    own = tenants.where(F.col("tenant_id") == tenant).select("client_id")
    if own.isEmpty():
        raise LookupError(f"no tenant {tenant}")
    return own


def checked_broadcast(rows: DataFrame, few: int = FEW) -> DataFrame:
    """Rows to be sent to all tasks if they are few, counted first; else to be joined by a shuffle."""
    return F.broadcast(rows) if rows.limit(few + 1).count() <= few else rows.hint("shuffle_merge")


def queue(items: DataFrame, status: str | None = None) -> DataFrame:
    """Review items, newest first; of one status if it is named."""
    return ordered(items if status is None else items.where(F.col("status") == status), "-loaded_at", "fund_id", "document")


def one(rows: DataFrame, condition: Column, what: str) -> DataFrame:
    """The rows of a single thing, which must be there."""
    found = rows.where(condition)
    if found.isEmpty():
        raise LookupError(f"no {what}")
    return found
