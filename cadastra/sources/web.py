"""Archive links of index pages, harvested in bulk from a table of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An anchor's href value: double-quoted, single-quoted or bare; attributes before it may quote any character.
ATTRIBUTE = r"""\s+(?!href\s*=)[^\s>"'=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
HREF = rf"""(?i)<a(?:{ATTRIBUTE})*+\s+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

# Character references: by number, and those names that XML has too.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
REFERENCE = rf"&(#[0-9]{{1,7}}|#[xX][0-9a-fA-F]{{1,6}}|{'|'.join(NAMED)});"

# Markup whose content is no element.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>"


def decoded(text: Column) -> Column:
    """The text with its character references resolved, each once; numbers of no character become U+FFFD."""

    def resolve(piece: Column) -> Column:
        name = F.regexp_extract(piece, f"^{REFERENCE}", 1)
        number = F.when(F.lower(name).startswith("#x"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(
            F.substr(name, F.lit(2))
        )
        code = number.try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        found = F.when(name.startswith("#"), F.when(valid, character).otherwise("\ufffd"))
        for known, value in NAMED.items():
            found = found.when(name == known, value)
        return F.when(name == "", piece).otherwise(F.concat(found, F.regexp_replace(piece, f"^{REFERENCE}", "")))

    pieces = F.split(text, f"(?={REFERENCE})", -1)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, resolve), "")).otherwise(text)


def harvest_links(pages: DataFrame, html: str, suffix: str = "") -> DataFrame:
    """One row per anchor whose target ends in ``suffix``, in any case; other columns are kept."""
    kept = [name for name in pages.columns if name != html]
    visible = F.regexp_replace(html, HIDDEN, "")
    targets = F.flatten(
        F.array(*[F.regexp_extract_all(visible, F.lit(HREF), F.lit(group)) for group in (1, 2, 3)])
    )
    links = pages.select(*kept, F.explode(targets).alias("href")).where(F.col("href") != "")
    links = links.withColumn("href", decoded(F.col("href")))
    return links.where(F.lower("href").endswith(suffix.lower())) if suffix else links
