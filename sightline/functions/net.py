"""IPv4 and host-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.values import column, strip

# Fixed value: four dotted groups of one to three digits, octet range unchecked.
IPV4_PATTERN = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def is_ip(value: Column | str) -> Column:
    return column(value).rlike(IPV4_PATTERN)


def ip_to_long(value: Column | str) -> Column:
    """Dotted quad to a number; null for text that is no address."""
    text = column(value)
    octets = F.split(F.when(is_ip(text), text), r"\.")
    parts = [F.get(octets, F.lit(i)).cast("long") for i in range(4)]
    in_range = F.greatest(*parts) <= 255
    number = parts[0]
    for part in parts[1:]:
        number = number * 256 + part
    return F.when(in_range, number)


def cidr_range(network: Column | str) -> tuple[Column, Column, Column]:
    """First address, last address and prefix length of an ``a.b.c.d/n`` block."""
    pieces = F.split(strip(network), "/")
    base = ip_to_long(F.get(pieces, F.lit(0)))
    length = F.get(pieces, F.lit(1)).try_cast("int")
    length = F.when(length.between(0, 32), length)
    size = F.expr("1L") * F.pow(F.lit(2.0), (32 - length)).cast("long")
    start = base - base % size
    return start, start + size - 1, length


def trim_host(value: Column | str, depth: int = 2) -> Column:
    """Last ``depth`` labels of a host name; addresses pass unchanged."""
    text = strip(value)
    return F.when(is_ip(text), text).otherwise(F.substring_index(text, ".", -depth))
