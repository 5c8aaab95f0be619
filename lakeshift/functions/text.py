"""Column expressions for names, numbers, positions and units. Each takes and returns Columns unless it says otherwise."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of sizes (powers of 1024), rates and counts (powers of 1000).
BYTE_UNITS = ["B", "kB", "MB", "GB", "TB", "PB", "EB"]
RATE_UNITS = ["Bit/s", "kBit/s", "MBit/s", "GBit/s", "TBit/s", "PBit/s", "EBit/s"]
COUNT_NAMES = ["", "thousands", "million", "billion", "trillion", "quadrillion", "quintillion"]

#: Words that need quotes as identifiers although they are lower case.
RESERVED = ("all and any array as asc both case cast check collate column constraint create default desc distinct do else end except false for foreign from grant group having in initially intersect into leading limit not null offset on only or order placing primary references select session_user some symmetric table then to trailing true union unique user using variadic when where window with time").split()


def quote_always(name: Column) -> Column:
    """The identifier in double quotes, inner ones doubled."""
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def quote_ident(name: Column) -> Column:
    """The identifier, in quotes only if it needs them."""
    return F.when(name.rlike("^[a-z_][a-z0-9_$]*$") & ~name.isin(RESERVED), name).otherwise(quote_always(name))


def quote_literal(value: Column) -> Column:
    """A string literal; NULL for null."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def qualified(nspname: Column, relname: Column) -> Column:
    return F.concat(quote_ident(nspname), F.lit("."), quote_ident(relname))


def one_line(text: Column) -> Column:
    """Restore-list names: line ends become blanks."""
    return F.regexp_replace(text, "[\\n\\r]", " ")


def lsn_parse(text: Column) -> Column:
    """"hi/lo" in hexadecimal as a number; null if malformed."""
    part = lambda k: F.conv(F.split_part(text, F.lit("/"), F.lit(k)), 16, 10).cast("long")
    return F.when(text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), F.shiftleft(part(1), 32) + part(2))


def lsn_format(lsn: Column, padded: bool = False) -> Column:
    """The number as "hi/lo"; padded, texts sort like the numbers."""
    hi, lo = F.hex(F.shiftrightunsigned(lsn, 32)), F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.concat(F.lpad(hi, 8, "0"), F.lit("/"), F.lpad(lo, 8, "0")) if padded else F.concat(hi, F.lit("/"), lo)


def _ladder(value: Column, base: int, most: int, units: list[str]) -> Column:
    """value / base^k with the first unit for which it is below most, cut to an integer."""
    out = F.concat(F.floor(value / float(base ** (len(units) - 1))).cast("long").cast("string"), F.lit(f" {units[-1]}"))
    for k in reversed(range(len(units) - 1)):
        scaled = value / float(base**k)
        out = F.when(scaled < most, F.concat(F.floor(scaled).cast("long").cast("string"), F.lit(f" {units[k]}"))).otherwise(out)
    return out


def pretty_bytes(n: Column) -> Column:
    return _ladder(n.cast("double"), 1024, 10240, BYTE_UNITS)


def pretty_rate(n: Column, ms: Column) -> Column:
    """Bits a second in powers of 1000, from bytes and milliseconds."""
    bits = n.cast("double") * 8000.0 / F.nullif(ms, F.lit(0)).cast("double")
    return F.when(ms == 0, F.lit("0 B/s")).otherwise(_ladder(bits, 1000, 10000, RATE_UNITS))


def pretty_count(n: Column) -> Column:
    thousands = F.concat(F.floor(n / 1000).cast("string"), F.lit(" "), F.lpad((n % 1000).cast("string"), 3, "0"))
    return F.when(n < 1000, n.cast("string")).when(n < 1_000_000, thousands).otherwise(_ladder(n.cast("double"), 1000, 10000, COUNT_NAMES))


def pretty_interval(ms: Column) -> Column:
    """Milliseconds as "350ms", " 2s728", "12s", " 3m05s", " 1h02m" or " 2d03h"."""
    s = F.floor(ms / 1000)
    pad = lambda x, n, c: F.lpad(x.cast("string"), n, c)
    two = lambda x: F.when(x < 10, pad(x, 2, " ")).otherwise(x.cast("string"))
    return (
        F.when(ms < 1000, F.concat(pad(ms, 3, " "), F.lit("ms")))
        .when(s < 10, F.concat(two(s), F.lit("s"), pad(ms % 1000, 3, "0")))
        .when(s < 60, F.concat(two(s), F.lit("s")))
        .when(s < 3600, F.concat(two(F.floor(s / 60)), F.lit("m"), pad(s % 60, 2, "0"), F.lit("s")))
        .when(s < 86400, F.concat(two(F.floor(s / 3600)), F.lit("h"), pad(F.floor(s % 3600 / 60), 2, "0"), F.lit("m")))
        .otherwise(F.concat(two(F.floor(s / 86400)), F.lit("d"), pad(F.floor(s % 86400 / 3600), 2, "0"), F.lit("h")))
    )


def parse_bytes(text: Column) -> Column:
    """"10 kB" as 10240; null for unknown units and malformed texts."""
    number = F.regexp_extract(text, r"^\s*(\d+)\s*([A-Za-z]*)\s*$", 1)
    unit = F.regexp_extract(text, r"^\s*(\d+)\s*([A-Za-z]*)\s*$", 2)
    scale = F.when(unit.isin("", "B"), F.lit(1))
    for k, u in enumerate(BYTE_UNITS[1:], 1):
        scale = scale.when(unit == u, F.lit(1024**k))
    return F.when(number != "", number.cast("decimal(20,0)") * scale).cast("long")


def parse_bool(text: Column) -> Column:
    """Unique prefixes of true, false, yes, no, on and off, and 1 and 0, in any case; else null."""
    t = F.lower(F.trim(text))
    of = lambda *words: F.lit(False) if not words else reduce(lambda a, b: a | b, [t.isin([w[:k] for k in range(n, len(w) + 1)]) for w, n in words])
    return F.when(of(("true", 1), ("yes", 1), ("on", 2), ("1", 1)), True).when(of(("false", 1), ("no", 1), ("off", 2), ("0", 1)), False)


def number_text(x: Column) -> Column:
    """A double as an integer if it is one, else with up to 17 decimals and no zeros at the end."""
    plain = F.rtrim(F.format_string("%.17f", x), F.lit("0"))
    return F.when(x.isNull(), F.lit("NULL")).when(x % 1 == 0, F.format_string("%.0f", x)).otherwise(plain)


def bool_text(x: Column) -> Column:
    return F.when(x.isNull(), F.lit("NULL")).when(x, "t").otherwise("f")


def same_value(a: Column, b: Column) -> Column:
    """Equality with nulls equal."""
    return a.eqNullSafe(b)


def blocked_function(names: Column, blocked: list[str]) -> Column:
    """Whether a comma-separated list holds one of the names as a whole."""
    return F.arrays_overlap(F.transform(F.split(names, ","), lambda x: F.trim(x)), F.array(*[F.lit(b) for b in blocked]))


def percent_encoded(text: Column) -> Column:
    """URI escaping in which a blank is %20."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def scrubbed(uri: Column) -> Column:
    """A connection string without its password."""
    x = F.regexp_replace(uri, r"(://[^:/@\s]*):[^@/\s]*@", "$1:****@")
    return F.regexp_replace(x, r"(?i)(password=)('[^']*'|[^\s&]*)", "$1****")


#: Classes of POSIX bracket expressions and their Java names.
POSIX_CLASSES = {"alpha": "\\p{Alpha}", "digit": "\\p{Digit}", "alnum": "\\p{Alnum}", "upper": "\\p{Upper}", "lower": "\\p{Lower}", "space": "\\s", "punct": "\\p{Punct}", "xdigit": "\\p{XDigit}", "blank": "\\p{Blank}", "cntrl": "\\p{Cntrl}", "print": "\\p{Print}", "graph": "\\p{Graph}", "word": "\\w"}


def posix_regex(pattern: str) -> str:
    """A POSIX extended regular expression (with the server's shorthands) for Java: classes, words' ends, brackets."""
    out, k, inside = [], 0, False
    while k < len(pattern):
        c = pattern[k]
        if inside:
            if m := re.match(r"\[:(\w+):\]", pattern[k:]):
                out.append(POSIX_CLASSES[m[1]])
                k += len(m[0])
                continue
            if c == "]" and k > first:
                inside = False
            elif c in "[&":  # Java reads these as nested classes and intersections
                c = "\\" + c
            out.append(c)
        elif c == "[":
            inside, first = True, k + 1 + (pattern[k + 1 : k + 2] == "^")
            if pattern.startswith(("[[:<:]]", "[[:>:]]"), k):
                out.append("\\b")
                k, inside = k + 7, False
                continue
            out.append(pattern[k:first])
            if pattern[first : first + 1] == "]":  # literal where it comes first
                out.append("\\]")
                k = first + 1
                first = k
                continue
            k = first
            first -= 1
            continue
        elif c == "\\" and pattern[k + 1 : k + 2] in ("m", "M", "y"):
            out.append("\\b")
            k += 1
        elif c == "\\":
            out.append(pattern[k : k + 2])
            k += 1
        else:
            out.append(c)
        k += 1
    if inside:
        raise ValueError(f"unterminated bracket in {pattern!r}")
    return "".join(out)
