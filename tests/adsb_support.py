"""Frames for tests, encoded from the public ADS-B definition (position, identification, velocity)."""

import math

CHARSET = "#ABCDEFGHIJKLMNOPQRSTUVWXYZ##### ###############0123456789######"


def zones(lat):
    """Number of longitude zones at a latitude."""
    if abs(lat) >= 87:
        return 1 if abs(lat) > 87 else 2
    if lat == 0:
        return 59
    return math.floor(2 * math.pi / math.acos(1 - (1 - math.cos(math.pi / 30)) / math.cos(math.radians(abs(lat))) ** 2))


def compact(lat, lon, odd):
    """17-bit latitude and longitude of a position."""
    dlat = 360 / (60 - odd)
    y = math.floor(2**17 * ((lat % dlat) / dlat) + 0.5)
    seen = dlat * (y / 2**17 + math.floor(lat / dlat))
    dlon = 360 / max(zones(seen) - odd, 1)
    return y % 2**17, math.floor(2**17 * ((lon % dlon) / dlon) + 0.5) % 2**17


def parity(bits):
    value = int(bits, 2) << 24
    for i in range(len(bits) + 24 - 1, 23, -1):
        if value >> i & 1:
            value ^= 0x1FFF409 << (i - 24)
    return value


def frame(icao, me, df=17):
    bits = f"{df:05b}{5:03b}{int(icao, 16):024b}{me}"
    return f"{int(bits, 2):022X}{parity(bits):06X}"


def position(icao, lat, lon, odd, altitude=None):
    y, x = compact(lat, lon, odd)
    n = 0 if altitude is None else (altitude + 1000) // 25
    alt = 0 if altitude is None else (n >> 4) << 5 | 1 << 4 | n & 15
    return frame(icao, f"{11:05b}000{alt:012b}0{odd}{y:017b}{x:017b}")


def identification(icao, name, type_code=4):
    return frame(icao, f"{type_code:05b}000" + "".join(f"{CHARSET.index(c):06b}" for c in name.ljust(8)))


def velocity(icao, east, north, climb):
    """Ground speed components in knots and climb in feet a minute (multiples of 64)."""
    axis = lambda v: f"{int(v < 0)}{abs(v) + 1:010b}"
    return frame(icao, f"{19:05b}001000000"[:8] + "00000" + axis(east) + axis(north) + "0" + f"{int(climb < 0)}{abs(climb) // 64 + 1:09b}" + "00" + "00000000")
