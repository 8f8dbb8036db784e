"""Image token arithmetic as column expressions."""

from pyspark.sql import Column, functions as F

# The published tiling rule.
MAX_SIDE = 2048
SHORT_SIDE = 768
TILE_SIDE = 512
BASE_TOKENS = 85
TILE_TOKENS = 170
FALLBACK_TOKENS = BASE_TOKENS + TILE_TOKENS          # unreadable file: one tile
LEGACY_TOKENS = BASE_TOKENS + 5 * TILE_TOKENS        # former flat estimate of five tiles

OK, CORRUPT, MISSING = "ok", "corrupt", "missing"


def tile_tokens(width="width", height="height") -> Column:
    """Tokens of one image before any model multiplier, from two integer columns.

    Fit inside the square, then shrink (never enlarge) the short side, truncating each time;
    a side truncated to zero leaves no tile and only the base tokens.
    """
    # The rule treats both sides alike, so it is written for the longer and the shorter one.
    longer, shorter = f"greatest({width}, {height})", f"least({width}, {height})"
    shorter = (f"CASE WHEN {longer} > {MAX_SIDE} "
               f"THEN CAST({shorter} * {MAX_SIDE}L / {longer} AS BIGINT) ELSE {shorter} END")
    longer = f"least({longer}, {MAX_SIDE}L)"
    longer = (f"CASE WHEN ({shorter}) > {SHORT_SIDE} "
              f"THEN CAST({longer} * {SHORT_SIDE}L / ({shorter}) AS BIGINT) ELSE {longer} END")
    shorter = f"least({shorter}, {SHORT_SIDE}L)"
    tiles = " * ".join(f"ceil(({side}) / {TILE_SIDE}.0D)" for side in (longer, shorter))
    return F.expr(f"CAST({BASE_TOKENS} + {TILE_TOKENS} * {tiles} AS BIGINT)")


# SQL text, so that one parse replaces many column calls; the model's columns
# (see operators.models) are in scope.
def billed(tile="tile_tokens", status="status"):
    """Billed tokens of one image: 0 if missing, one tile if unreadable."""
    return (f"CASE WHEN NOT supports_vision THEN 0L "
            f"WHEN {status} = '{OK}' THEN CAST({tile} * image_token_multiplier AS BIGINT) "
            f"WHEN {status} = '{CORRUPT}' "
            f"THEN CAST({FALLBACK_TOKENS} * image_token_multiplier AS BIGINT) ELSE 0L END")


def base_from_billed(tokens):
    """Tokens backed out of the billed number; truncation may lose one."""
    return (f"CASE WHEN image_token_multiplier > 1 "
            f"THEN CAST({tokens} / image_token_multiplier AS BIGINT) ELSE {tokens} END")


def _big_endian(content, start, size):
    return F.conv(F.hex(F.substring(content, start, size)), 16, 10).cast("long")


def is_png(content: Column) -> Column:
    return ((F.hex(F.substring(content, 1, 8)) == F.lit("89504E470D0A1A0A"))
            & (F.length(content) >= 24))


def png_width(content: Column) -> Column:
    return _big_endian(content, 17, 4)


def png_height(content: Column) -> Column:
    return _big_endian(content, 21, 4)
