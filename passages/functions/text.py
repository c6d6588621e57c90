"""Text, token-array and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space; plain \s in Java is ASCII only.
WHITESPACE = r"(?U)\s+"
LINE_END = r"\r?\n"
# A piece that ends in a letter or a number of any script.
ALPHANUMERIC_END = r"[\p{IsAlphabetic}\p{N}]\z"


def words(text: Column | str) -> Column:
    """White-space separated words, in order."""
    return F.array_remove(F.split(text, WHITESPACE), "")


def drop_empty_lines(text: Column | str) -> Column:
    """Remove lines without any character; white-space-only lines stay."""
    return F.array_join(F.array_remove(F.split(text, LINE_END), ""), "\n")


def source_name(path: Column | str) -> Column:
    """File stem of a path: the last segment up to its last dot.

    A name whose only dot comes first is kept whole; a path without a name
    gives NULL.
    """
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    stem = F.regexp_extract(name, r"(?s)\A(.+)\.[^.]*\z", 1)
    return F.when(name != "", F.when(stem != "", stem).otherwise(name))


def strip_line_end(text: Column | str) -> Column:
    """Remove one trailing newline and the carriage return before it."""
    return F.regexp_replace(text, r"\r?\n\z", "")


def strip_prompt(output: Column | str, prompt: Column | str) -> Column:
    """Generated ids without the leading prompt ids."""
    output, prompt = _col(output), _col(prompt)
    return F.slice(output, F.size(prompt) + 1, F.size(output))


def fit_context(
    tokens: Column | str, max_length: int, sample_length: int, as_written: bool = False
) -> Column:
    """Cut a prompt to the tail that leaves room for ``sample_length`` new tokens.

    The default keeps the last ``max_length - 10 - to_sample`` tokens. With
    ``as_written`` the kept count is the number of tokens that had to go.
    """
    tokens = _col(tokens)
    size = F.size(tokens)
    budget = max(max_length - 10 - max(sample_length - 1, 0), 0)
    excess = size - (max_length - 10 - max(sample_length - 1, 0))
    keep = F.least(size, excess) if as_written else F.least(size, F.lit(budget))
    return F.when(excess > 0, F.slice(tokens, size - keep + 1, keep)).otherwise(tokens)


def cut_at_eos(
    tokens: Column | str, eos: Column, sample_length: int, skip_first: bool = False
) -> Column:
    """Keep generated tokens up to and including the first ``eos``.

    At most ``sample_length`` tokens remain. With ``skip_first`` an ``eos`` in first
    place does not stop the output.
    """
    tokens = _col(tokens)
    if skip_first:
        found = F.array_position(F.slice(tokens, 2, F.size(tokens)), eos)
        found = F.when(found > 0, found + 1).otherwise(0)
    else:
        found = F.array_position(tokens, eos)
    limit = F.when(found > 0, F.least(found, F.lit(sample_length))).otherwise(sample_length)
    return F.slice(tokens, F.lit(1), limit.cast("int"))


def display_token(token: Column | str) -> Column:
    """Printable form: the word-start mark as a space, the newline byte as itself."""
    return F.replace(F.replace(_col(token), F.lit("▁"), F.lit(" ")), F.lit("<0x0A>"), F.lit("\n"))


def format_size(size: Column | str) -> Column:
    """Bytes as ``B``, ``KB``, ``MB`` or ``GB`` in powers of 1000, two decimals.

    Digits come from integer arithmetic, so the result does not depend on how a
    binary fraction prints.
    """
    size = _col(size).cast("long")

    def scaled(unit: int, name: str) -> Column:
        cents = whole_div(size + unit // 200, unit // 100)
        return F.concat(
            whole_div(cents, 100).cast("string"),
            F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"),
            F.lit(name),
        )

    return (
        F.when(size < 1_000, F.concat(size.cast("string"), F.lit("B")))
        .when(size < 1_000_000, scaled(1_000, "KB"))
        .when(size < 1_000_000_000, scaled(1_000_000, "MB"))
        .otherwise(scaled(1_000_000_000, "GB"))
    )


def whole_div(left: Column, right: Column | int) -> Column:
    """Integer division of longs."""
    return F.call_function("div", left, right if isinstance(right, Column) else F.lit(right))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
