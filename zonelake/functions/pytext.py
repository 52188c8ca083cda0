"""Texts as Python prints them, from native Spark expressions.

Error messages of the validator quote values with ``repr`` and alerts carry
``json.dumps``. Containers keep the document's key order, which a VARIANT does
not, so they are printed from the JSON text token by token.

Before Java 19 some reals get more digits than the shortest that Python finds;
those with an exponent are tried with 15 to 17 digits (subnormals differ).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelake.functions.util import as_col, let

# Characters that Python's str.isprintable() denies, the space apart.
_HIDDEN = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}&&[^ ]]|[\p{Zs}&&[^ ]]"
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*|true|false|null|[\[\]{}:,]'


def _hex(code: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(code)), width, "0")


def _by_character(s: Column, needs: str, escape) -> Column:
    """``s`` with every character that matches ``needs`` escaped; most texts
    have none and stay as they are."""
    chars = F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))
    return F.when(F.regexp_like(s, F.lit(needs)), F.array_join(
        F.transform(chars, lambda c: F.when(F.regexp_like(c, F.lit(needs)), escape(c)).otherwise(c)), "")).otherwise(s)


def _spelt(s: Column, names) -> Column:
    for char, name in names:
        s = F.replace(s, F.lit(char), F.lit(name))
    return s


def py_str(text) -> Column:
    """``repr`` of a string."""

    def hidden(c: Column) -> Column:
        code = F.ascii(c)
        return (F.when(code < 256, F.concat(F.lit("\\x"), _hex(code, 2)))
                .when(code < 65536, F.concat(F.lit("\\u"), _hex(code, 4)))
                .otherwise(F.concat(F.lit("\\U"), _hex(code, 8))))

    def quoted(s: Column) -> Column:
        body = _spelt(s, (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")))
        double = F.concat(F.lit('"'), body, F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(s.contains("'") & ~s.contains('"'), double).otherwise(single)

    return let(let(text, quoted), lambda s: _by_character(s, _HIDDEN, hidden))


def _shortest(d: Column) -> Column:
    """A real in Java's notation, with the fewest of 15 to 17 digits that give
    it back where Java prints more."""

    def tried(k: int) -> Column:
        out = F.regexp_replace(F.format_string(f"%.{k - 1}E", d), r"0+E", "E")
        return F.regexp_replace(F.regexp_replace(out, r"\.E", ".0E"), r"E\+?(-?)0*", "E$1")

    def shorter(s: Column) -> Column:
        fits = F.filter(F.array(*(tried(k) for k in (15, 16, 17))), lambda t: t.cast("double") == d)
        return F.when(s.contains("E") & (F.length(s) > 19), F.coalesce(F.try_element_at(fits, F.lit(1)), s)).otherwise(s)

    return let(d.cast("string"), shorter)


def py_float(value) -> Column:
    """``repr`` of a real: plain digits from 1e-4 up to 1e16, else an exponent
    of two digits or more."""

    def printed(p: Column) -> Column:
        """From sign, first digit, other digits and exponent."""
        rest, e = p["rest"], p["e"]
        digits, power = F.concat(p["first"], rest), F.abs(e).cast("string")
        scientific = F.concat(p["first"], F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)), F.lit("e"),
                              F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                              F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power))
        whole = F.when(F.length(digits) <= e + 1, F.concat(F.rpad(digits, e + 1, "0"), F.lit(".0"))).otherwise(
            F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, F.length(digits))))
        small = F.concat(F.lit("0.000"), digits)  # only an exponent of -4 is left
        return F.concat(p["sign"], F.when((e >= 16) | (e < -4), scientific).when(e < 0, small).otherwise(whole))

    def from_java(s: Column) -> Column:
        part = lambda k: F.regexp_extract(s, r"^(-?)([0-9])\.(?:0|([0-9]+))E(-?[0-9]+)$", k)
        parts = F.struct(part(1).alias("sign"), part(2).alias("first"), part(3).alias("rest"),
                         part(4).try_cast("int").alias("e"))
        return (F.when(s == "Infinity", F.lit("inf")).when(s == "-Infinity", F.lit("-inf"))
                .when(~s.contains("E"), s).otherwise(let(parts, printed)))

    return let(let(as_col(value).cast("double"), _shortest), from_java)


def py_number(token) -> Column:
    """``repr`` of a JSON number: integers keep their digits."""
    t = as_col(token)
    return F.when(F.regexp_like(t, F.lit("[.eE]")), py_float(t)).when(t == "-0", F.lit("0")).otherwise(t)


def py_json(text) -> Column:
    """``repr`` of the value of a JSON text, of any depth."""

    def printed(t: Column) -> Column:
        return (
            F.when(t.startswith('"'), py_str(F.try_variant_get(F.try_parse_json(t), "$", "string")))
            .when(t == ",", F.lit(", ")).when(t == ":", F.lit(": "))
            .when(t == "true", F.lit("True")).when(t == "false", F.lit("False")).when(t == "null", F.lit("None"))
            .when(F.regexp_like(t, F.lit("^[-0-9]")), py_number(t))
            .otherwise(t)
        )

    return F.array_join(F.transform(F.regexp_extract_all(as_col(text), F.lit(_TOKEN), F.lit(0)), printed), "")


def json_string(text) -> Column:
    """``json.dumps`` of a string: ASCII only, lower-case escapes, characters
    beyond the first plane as two surrogates."""
    unit = lambda n: F.concat(F.lit("\\u"), _hex(n, 4))

    def escaped(c: Column) -> Column:
        beyond = F.ascii(c) - 65536
        return F.when(F.ascii(c) < 65536, unit(F.ascii(c))).otherwise(F.concat(
            unit(F.shiftright(beyond, 10) + 0xD800), unit(beyond.bitwiseAND(F.lit(1023)) + 0xDC00)))

    names = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"))
    body = let(_spelt(as_col(text), names), lambda s: _by_character(s, r"[^\x20-\x7e]", escaped))
    return F.concat(F.lit('"'), body, F.lit('"'))
