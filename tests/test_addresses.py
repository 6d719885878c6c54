"""Addresses against the standard library, networks against a scan, clients by example."""

import ipaddress
import random

from pyspark.sql import functions as F

from claimsight.functions import addresses as ad


def digits_of(text):
    """The 32 digits by the standard library."""
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return f"{int(a) if a.version == 6 else (0xFFFF << 32) + int(a):032x}"


def test_addresses_equal_the_standard_library(spark):
    rng = random.Random(5)
    texts = ["::", "::1", "1::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", ":::", "1:::2",
             "1::2::3", "12345::", "g::", "", ":", "1:2", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1.2.3.256", "01.2.3.4", "::1.2.3.4",
             "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "1.2.3.4::", "::1.2.3.4:5", "FE80::AbCd", "1:2:3:4:5:6:7:",
             ":1:2:3:4:5:6:7", "0.0.0.0", "255.255.255.255", "::1.2.3.400", "1::2:3:4:5:6:7:8", "..."]
    for _ in range(200):
        n = rng.getrandbits(128) & rng.choice([-1, 0xFFFF << 40, ~(0xFFFFFF << 30), 0xFFFFFFFF])
        texts += [str(ipaddress.IPv6Address(n)), ipaddress.IPv6Address(n).exploded, str(ipaddress.IPv4Address(n & 0xFFFFFFFF))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", ad.address_digits(F.col("t")).alias("d")).collect():
        assert r.d == digits_of(r.t), r.t


def test_ports_brackets_and_zones_are_left_out(spark):
    rows = [("1.2.3.4:80", "1.2.3.4"), ("[::1]:443", "::1"), ("[::1]", "::1"), (" fe80::1%eth0 ", "fe80::1"), ("[fe80::1%0]:1", "fe80::1"),
            ("1.2.3.4:", "no"), ("[::1", "no"), ("host", "no"), (None, "no")]
    df = spark.createDataFrame(rows, "t string, bare string")
    for r in df.select("*", ad.address_digits(F.col("t")).alias("d")).collect():
        assert r.d == digits_of(r.bare), r.t


def test_networks_equal_a_scan(spark):
    rng = random.Random(6)
    nets, texts = [], ["10.0.0.0", "10.255.255.255", "no address", None]
    for i in range(60):
        if i % 3:
            bits, host = rng.randint(0, 32), ipaddress.IPv4Address(0x0A000000 + rng.getrandbits(20))
        else:
            bits, host = rng.randint(0, 128), ipaddress.IPv6Address((0xFD << 120) + (rng.getrandbits(6) << 90) + rng.getrandbits(8))
        nets.append(ipaddress.ip_network(f"{host}/{bits}", strict=False))
        texts += [str(host), str(type(host)(int(host) ^ rng.getrandbits(10)))]
    names = {n: f"net{i:02d}" for i, n in reversed(list(enumerate(nets)))}
    rows = [(str(n), f"net{i:02d}") for i, n in enumerate(nets)] + [("10.0.0.0/33", "a"), ("x/8", "a"), ("10.0.0.0/-1", "a"), (None, "a")]
    table = spark.createDataFrame(rows, "cidr string, owner string")
    asked = spark.createDataFrame([(t, "old") for t in texts], "t string, owner string")
    asked = asked.withColumn("digits", ad.address_digits(F.col("t")))
    got = ad.with_network(asked, "digits", table, "cidr", ["owner"]).collect()
    assert len(got) == len(texts)

    def wide(n):  # an IPv4 network among the mapped IPv6 ones
        return n if n.version == 6 else ipaddress.ip_network(f"::ffff:{n.network_address}/{n.prefixlen + 96}")

    for r in got:
        inside = [n for n in names if r.digits and ipaddress.IPv6Address(int(r.digits, 16)) in wide(n)]
        best = min(inside, key=lambda n: (-wide(n).prefixlen, names[n]), default=None)
        assert r.owner == names.get(best), r.t
    empty = ad.with_network(asked, "digits", table.limit(0), "cidr", ["owner"]).collect()
    assert {r.owner for r in empty} == {None} and len(empty) == len(texts)


def test_clients(spark):
    rows = [
        ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/120.0 Safari/537.36 Edg/119.0", ("edge", 119, "windows")),
        ("Mozilla/5.0 (Linux; Android 14) AppleWebKit/537.36 Chrome/120.0 Mobile Safari/537.36", ("chrome", 120, "android")),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 14_1) AppleWebKit/605 Version/17.1 Safari/605", ("safari", 17, "macos")),
        ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", ("bot", 2, "other")),
        ("some crawler", ("bot", None, "other")),
        ("", ("other", None, "other")),
    ]
    df = spark.createDataFrame([(a,) for a, _ in rows] + [(None,)], "a string")
    got = {r.a: r.c for r in df.select("a", ad.client_of(F.col("a")).alias("c")).collect()}
    assert got.pop(None) is None
    assert {a: tuple(c) for a, c in got.items()} == dict(rows)
