"""Checks before a capture starts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(Exception):
    """The source can't be captured as it is set up."""


@dataclass
class GateReport:
    warnings: list[str] = field(default_factory=list)


#: Server variables, what they must be, and what sets them.
REQUIRED = (
    ("binlog_format", "ROW", "SET GLOBAL binlog_format = 'ROW';"),
    ("binlog_row_image", "FULL", "SET GLOBAL binlog_row_image = 'FULL';"),
    ("binlog_row_metadata", "FULL", "SET PERSIST binlog_row_metadata = 'FULL';"),
    ("gtid_mode", "ON", "SET GLOBAL gtid_mode = ON;"),
)
ADVISED = ("enforce_gtid_consistency", "ON")


def check_variables(held: dict[str, str]) -> GateReport:
    for name, wanted, remedy in REQUIRED:
        value = held.get(name)
        if value is None:
            raise GateError(f"server variable {name} is missing; to set it: {remedy}")
        if value.upper() != wanted:
            raise GateError(f"{name} is {value}, but must be {wanted}; to set it: {remedy}")
    name, wanted = ADVISED
    if held.get(name) == wanted:
        return GateReport()
    return GateReport([f"{name} is {held[name]}; {wanted} is advised" if name in held else f"{name} isn't reported; {wanted} is advised"])


def variable_report(variables: DataFrame) -> DataFrame:
    """(source_id, name, status) for every gate of every source; variables: source_id, name, value.

    status: ok, missing or wrong for what is required, ok or warning for what is advised.
    """
    wanted = [(name, value, True) for name, value, _ in REQUIRED] + [(*ADVISED, False)]
    gates = F.array(*[F.struct(F.lit(n).alias("gate"), F.lit(v).alias("wanted"), F.lit(r).alias("required")) for n, v, r in wanted])
    held = variables.groupBy("source_id").agg(F.map_from_entries(F.collect_set(F.struct("name", "value"))).alias("held"))
    each = held.select("source_id", "held", F.inline(gates)).withColumn("value", F.col("held")[F.col("gate")])
    status = (
        F.when(F.col("required") & F.col("value").isNull(), "missing")
        .when(F.col("required") & (F.upper("value") != F.col("wanted")), "wrong")
        .when(~F.col("required") & (F.col("value").isNull() | (F.col("value") != F.col("wanted"))), "warning")
        .otherwise("ok")
    )
    return each.select("source_id", F.col("gate").alias("name"), status.alias("status"))


def check_topology(hello: dict) -> None:
    if hello.get("msg") == "isdbgrid":
        raise GateError("sharded clusters aren't supported, only replica sets")
    if not (isinstance(hello.get("setName"), str) and hello["setName"]):
        raise GateError("a standalone server has no change streams; a replica set of one node is enough")


def check_version(version: str) -> None:
    major = version.replace("-", ".").split(".")[0]
    if not (major.isascii() and major.isdigit() and int(major) >= 8):
        raise GateError(f"version {version} is below 8.0")


def post_images_enabled(collection: dict) -> bool:
    options = collection.get("options") or {}
    return (options.get("changeStreamPreAndPostImages") or {}).get("enabled") is True


def covers_database(resource: dict, database: str) -> bool:
    if resource.get("anyResource") is True or resource.get("cluster") is True:
        return True
    return resource.get("db") in ("", database) if isinstance(resource.get("db"), str) else False


def check_privileges(status: dict, database: str) -> None:
    """Without an authenticated user, access control is off and all is allowed."""
    auth = status.get("authInfo")
    if not auth or not auth.get("authenticatedUsers"):
        return
    if "authenticatedUserPrivileges" not in auth:
        raise GateError("the authenticated session doesn't tell its privileges")
    own = [p for p in auth["authenticatedUserPrivileges"] if isinstance(p, dict) and covers_database(p.get("resource") or {}, database)]
    if not {"find", "changeStream"} <= {action for p in own for action in p.get("actions") or ()}:
        raise GateError(f"the user needs find and changeStream on database {database}")


def oplog_window(oldest: int, newest: int) -> int:
    """Seconds that the source's own log reaches back; never below 0."""
    return max(0, newest - oldest)
