"""Public-address test for IPv4 and IPv6 text, as one built-in expression."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# IPv4 blocks that are not public, and addresses inside them that are.
IPV4_BLOCKED = (
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24",
    "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24",
    "224.0.0.0/4", "240.0.0.0/4",
)
IPV4_ALLOWED = ("192.0.0.9/32", "192.0.0.10/32")
# The same for IPv6. IPv4 addresses written as IPv6 fall into the first block.
IPV6_BLOCKED = (
    "::/3", "4000::/3", "6000::/3", "8000::/3", "a000::/3", "c000::/3", "e000::/4", "f000::/5",
    "f800::/6", "fc00::/7", "fe00::/9", "fe80::/10", "ff00::/8",
    "2001::/23", "2001:db8::/32", "2002::/16",
)
IPV6_ALLOWED = (
    "2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28", "2001:30::/28",
)

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def _within(value: Column, blocks: tuple[str, ...], bound) -> Column:
    inside = F.lit(False)
    for block in map(ipaddress.ip_network, blocks):
        inside = inside | value.between(bound(block[0]), bound(block[-1]))
    return inside


def _ipv4_number(ip: Column) -> Column:
    octets = F.split(ip, r"\.")
    return F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, o: acc * 256 + o.cast("bigint"))


def _ipv4_public(ip: Column) -> Column:
    return let(
        _ipv4_number(ip), lambda n: ~_within(n, IPV4_BLOCKED, int) | _within(n, IPV4_ALLOWED, int)
    )


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _dotted_tail_as_groups(ip: Column) -> Column:
    """A trailing IPv4 part as two hex groups."""
    tail = F.regexp_extract(ip, rf":({_IPV4})\z", 1)

    def rewrite(part: Column) -> Column:
        digits = F.lpad(F.lower(F.hex(_ipv4_number(part))), 8, "0")
        return F.concat(
            F.regexp_replace(ip, r"[0-9.]+\z", ""), F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4)
        )

    return let(tail, lambda part: F.when(part != "", rewrite(part)).otherwise(ip))


def _filled(halves: Column) -> Column:
    """All eight groups, with ``::`` standing for at least one of them."""

    def fill(left: Column, right: Column) -> Column:
        missing = 8 - F.size(left) - F.size(right)
        return F.when(missing >= 1, F.concat(left, F.array_repeat(F.lit("0"), missing), right))

    both = F.when(
        F.size(halves) == 2,
        let(
            _groups(F.element_at(halves, 1)),
            lambda left: let(_groups(F.element_at(halves, 2)), lambda right: fill(left, right)),
        ),
    )
    return F.when(F.size(halves) == 1, F.split(F.element_at(halves, 1), ":")).otherwise(both)


def _ipv6_hex(ip: Column) -> Column:
    """The address as 32 hex digits, or null when it is not one."""
    bare = F.lower(F.regexp_replace(ip, r"%[^%]+\z", ""))
    halves = F.split(let(bare, _dotted_tail_as_groups), "::")

    def joined(groups: Column) -> Column:
        valid = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike(r"^[0-9a-f]{1,4}\z"))
        return F.when(valid, F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))

    return let(let(halves, _filled), joined)


def _ipv6_public(digits: Column) -> Column:
    def bound(address) -> str:
        return address.exploded.replace(":", "")

    return ~_within(digits, IPV6_BLOCKED, bound) | _within(digits, IPV6_ALLOWED, bound)


def address_is_public(ip: Column) -> Column:
    """Whether an address is reachable from the public internet; null for text that is no address."""
    return F.when(ip.rlike(rf"^{_IPV4}\z"), _ipv4_public(ip)).otherwise(let(_ipv6_hex(ip), _ipv6_public))


def is_public_address(ip: Column) -> Column:
    """The same with false for text that is no address."""
    return F.coalesce(address_is_public(ip), F.lit(False))

