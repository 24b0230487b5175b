"""Free-text normalisation, tokens, lexicon category and stem search as column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words, abbreviations and category prefixes of the orientation notes.
STOP_WORDS = (
    "a al con de del el en es la las lo los para por se su sus un una y o que "
    "durante tras sin sobre le les no ha han muy mas"
).split()
ABBREVIATIONS = (("est.", "estudiante"), (" q ", " que "))
LEXICON = {
    "academico": ["rendimiento", "nota", "refuerzo", "ejercicio", "tarea", "recuperacion",
                  "contenido", "minimo"],
    "asistencia": ["inasistencia", "falta", "ausencia", "retraso", "asistencia", "justific"],
    "familiar": ["familia", "hogar", "representante"],
    "conducta": ["conducta", "disruptiv", "conflicto", "companero", "llamado"],
    "motivacion": ["motivacion", "desinteres", "desanimo", "meta", "continuar"],
}
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]"
UNDETERMINED = "indeterminada"
# Spanish stems of the saved search "inasistencias ausencias faltas".
ABSENCE_STEMS = ["inasisten", "ausenci", "falt"]


@lru_cache(maxsize=1)
def _ascii_folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without its non-ASCII part, as (from, to, multi-letter map);
    ``from`` is longer than ``to``: its tail is deleted.

    Derived from the Unicode database for every code point of all planes."""
    src, dst, dropped, multi = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.category(ch) in ("Cs", "Cn", "Co"):
            continue
        plain = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(plain) == 1:
            src.append(ch)
            dst.append(plain)
        elif len(plain) > 1:
            multi[ch] = plain
        elif code < 0x370 or 0x2000 <= code < 0x2070:
            dropped.append(ch)  # Latin letters, marks and punctuation without an ASCII part
    return "".join(src + dropped), "".join(dst), multi


def fold_ascii(text: Column) -> Column:
    """Accents stripped and remaining non-ASCII dropped, without leaving the JVM.

    Single-letter results go through ``translate``; a sign that decomposes into several
    letters is replaced by name, once per distinct sign present in the text."""
    src, dst, multi = _ascii_folding()
    lookup = F.create_map(*[F.lit(x) for pair in sorted(multi.items()) for x in pair])
    signs = "[" + "".join(sorted(multi)) + "]"
    plain = F.translate(text, src, dst)
    present = F.array_distinct(F.regexp_extract_all(plain, F.lit(f"({signs})")))
    widened = F.aggregate(present, plain, lambda out, c: F.replace(out, c, lookup[c]))
    left = plain.rlike(r"[^\x00-\x7F]")
    return F.when(left, F.regexp_replace(widened, r"[^\x00-\x7F]", "")).otherwise(plain)


def normalise_text(text: Column, abbreviations=ABBREVIATIONS) -> Column:
    """Lower case, abbreviations expanded as substrings, ASCII letters, digits, single spaces."""
    out = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    for short, full in abbreviations:
        out = F.replace(out, F.lit(short), F.lit(full))
    out = F.regexp_replace(fold_ascii(out), "[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(out, " +", " "))


def tokens(normalised: Column, stop_words=STOP_WORDS) -> Column:
    """Words of three letters or more that are no stop words."""
    return F.filter(F.split(normalised, " "),
                    lambda w: (F.length(w) > 2) & ~w.isin(*stop_words))


def prefix_hits(normalised: Column, prefixes, stop_words=STOP_WORDS) -> Column:
    """Number of tokens starting with any prefix, counted by one regular expression."""
    any_prefix = "|".join(re.escape(p) for p in prefixes)
    stops = "|".join(re.escape(w) for w in stop_words)
    skip = f"(?!(?:{stops})(?: |$))" if stops else ""
    return F.regexp_count(normalised, F.lit(f"(?<![^ ])(?=[^ ]{{3}}){skip}(?:{any_prefix})[^ ]*"))


def categorise(normalised: Column, lexicon=LEXICON, stop_words=STOP_WORDS) -> Column:
    """Category with most token hits; a tie or no hit is undetermined."""
    hits = F.struct(*[prefix_hits(normalised, ps, stop_words).alias(name)
                      for name, ps in lexicon.items()])

    def decide(h: Column) -> Column:
        best = F.greatest(*[h[name] for name in lexicon]) if len(lexicon) > 1 else h[next(iter(lexicon))]
        leaders = sum((h[name] == best).cast("int") for name in lexicon)
        winner = F.coalesce(*[F.when(h[name] == best, F.lit(name)) for name in lexicon])
        return F.when((best == 0) | (leaders > 1), F.lit(UNDETERMINED)).otherwise(winner)

    # one-element array as a let-binding: the regular expressions run once per row
    return F.transform(F.array(hits), decide)[0]


def mentions(normalised: Column, stems) -> Column:
    """True when some word starts with one of the stems."""
    return normalised.rlike("(?<![^ ])(?:" + "|".join(re.escape(s) for s in stems) + ")")


def strip_blanks(value: Column) -> Column:
    """Blanks of every kind (tabs, line ends, Unicode spaces) off both ends."""
    return F.regexp_replace(value, rf"^{BLANKS}+|{BLANKS}+$", "")


def standardise(value: Column, catalogue_map: dict[str, str], fold: bool = False) -> Column:
    """Trimmed lower-case code mapped to the catalogue; unmapped codes stay as they are."""
    clean = F.lower(strip_blanks(value))
    if fold:
        clean = fold_ascii(clean)
    lookup = F.create_map(*[F.lit(x) for pair in catalogue_map.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, clean), clean)

