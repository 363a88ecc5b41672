"""Addresses: host part and truncation of IPs, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_V4 = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}"
_GROUPS = r"^[0-9a-fA-F]{1,4}(:[0-9a-fA-F]{1,4})*$"


def host(remote: Column) -> Column:
    """Host of ``host:port`` or ``[host]:port``; the value itself if it has no port."""
    bracket = F.regexp_extract(remote, r"^\[(.*)\]:\d*$", 1)
    plain = F.regexp_extract(remote, r"^([^:]*):\d*$", 1)
    return F.when(bracket != "", bracket).when(remote.rlike(r"^[^:]*:\d*$"), plain).otherwise(remote)


def anonymize_v4(address: Column) -> Column:
    """/24 of an IPv4 address, empty for anything else."""
    return F.when(address.rlike(f"^{_V4}$"), F.regexp_replace(address, r"\d+$", "0")).otherwise("")


def _groups(address: Column) -> Column:
    """The eight groups of an IPv6 address without zone as numbers; null if it is unreadable."""
    quad = F.transform(F.split(F.regexp_extract(address, f":({_V4})$", 1), r"\."), lambda x: x.try_cast("int"))
    pair = lambda i: F.lower(F.hex(F.get(quad, F.lit(i)) * 256 + F.get(quad, F.lit(i + 1))))
    plain = F.when(address.rlike(f":{_V4}$"), F.concat(F.regexp_extract(address, f"^(.*:){_V4}$", 1), pair(0), F.lit(":"), pair(2))).otherwise(address)
    sides = F.split(plain, "::")
    listed = lambda x: F.when(x == "", F.array().cast("array<string>")).when(x.rlike(_GROUPS), F.split(x, ":"))
    left, right = listed(F.get(sides, F.lit(0))), listed(F.get(sides, F.lit(1)))
    gap = 8 - F.size(left) - F.size(right)
    short = F.when(gap >= 1, F.concat(left, F.array_repeat(F.lit("0"), gap.cast("int")), right))
    full = F.when(F.size(sides) == 1, F.when(F.size(left) == 8, left)).when(F.size(sides) == 2, short)
    return F.transform(full, lambda x: F.conv(x, 16, 10).cast("int"))


def anonymize_v6(address: Column) -> Column:
    """/48 of an IPv6 address, a mapped IPv4 one as IPv4, the zone dropped; empty for anything else."""
    bare = F.when(address.rlike("^[^%]*(%.+)?$"), F.regexp_replace(address, "%.*$", ""))

    def written(g: Column) -> Column:
        mapped = F.forall(F.slice(g, 1, 5), lambda x: x == 0) & (F.get(g, F.lit(5)) == 0xFFFF)
        high, low = F.get(g, F.lit(6)), F.get(g, F.lit(7))
        v4 = F.concat_ws(".", F.floor(high / 256).cast("string"), (high % 256).cast("string"), F.floor(low / 256).cast("string"), F.lit("0"))
        kept = F.when(F.get(g, F.lit(2)) != 0, 3).when(F.get(g, F.lit(1)) != 0, 2).when(F.get(g, F.lit(0)) != 0, 1).otherwise(0)
        head = F.array_join(F.transform(F.slice(g, F.lit(1), kept), lambda x: F.lower(F.hex(x))), ":")
        return F.when(mapped, v4).otherwise(F.concat(head, F.lit("::")))

    return F.coalesce(F.transform(F.array(_groups(bare)), lambda g: F.when(g.isNotNull(), written(g)))[0], F.lit(""))


def anonymize(address: Column) -> Column:
    """IPv4 to its /24, IPv6 to its /48 (mapped IPv4 as IPv4, zone dropped), unreadable or null to empty."""
    a = F.coalesce(address, F.lit(""))
    return F.when(F.contains(a, F.lit(":")), anonymize_v6(a)).otherwise(anonymize_v4(a))
