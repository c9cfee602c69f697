"""Text functions: Column in, Column out, all inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from webgrain.lookups import CHUNK_CHARS, PROMPT_TEMPLATE

# --- fixed values: the characters Python's str.strip() removes; splitlines() breaks on _BREAKS ---
_BREAKS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85  "
_BLANKS = (
    "\t\x1f \xa0            "
    "  　"
)
# --------------------------------------------------------------------------------------------------
_SPACE = f"[{_BREAKS}{_BLANKS}]"


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space from both ends."""
    return F.btrim(c, F.lit(_BREAKS + _BLANKS))


def split_lines(c: Column) -> Column:
    return F.split(c, f"\r\n|[{_BREAKS}]")


def clean_lines(c: Column) -> Column:
    """Strip each line, drop empty lines, join with a line feed."""
    lines = F.transform(F.split(c, f"[{_BREAKS}]"), strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def partition_text(c: Column, max_length: int = CHUNK_CHARS) -> Column:
    """Greedy chunks of whole words (split on single spaces).

    A word joins the chunk while ``len(chunk) + len(word) < max_length``, the joining space not
    counted: a chunk is then the longest run of at most ``max_length`` characters ending before
    a space, or one longer word. A first word of ``max_length`` or more leaves an empty chunk
    in front. One regex pass over the whole text, no state.
    """
    chunk = rf"(?s)(.{{0,{max_length}}}|[^ ]*) "
    chunks = F.regexp_extract_all(F.concat(c, F.lit(" ")), F.lit(chunk), F.lit(1))
    first = F.length(F.substring_index(c, " ", 1))
    return F.when(first >= max_length, F.concat(F.array(F.lit("")), chunks)).otherwise(chunks)


def http_body(c: Column) -> Column:
    """Third part of a stripped WARC record (after two header blocks), else empty."""
    return F.coalesce(F.get(F.split(strip(c), "\r\n\r\n", 3), F.lit(2)), F.lit(""))


def slugify(c: Column) -> Column:
    """Join the words with ``-`` when there is more than one, else leave the text as it is."""
    words = F.filter(F.split(c, f"{_SPACE}+"), lambda x: x != "")
    return F.when(F.size(words) > 1, F.array_join(words, "-")).otherwise(c)


def keyword_form(c: Column, slashes: bool = False) -> Column:
    """Dashes and underscores (and slashes) to spaces, stripped, lower case."""
    marks = "/-_" if slashes else "-_"
    return F.lower(strip(F.translate(c, marks, " " * len(marks))))


def prompt(content: Column, summary: Column) -> Column:
    """Fill the summary prompt; missing values print as ``None``."""
    head, rest = PROMPT_TEMPLATE.split("{content}")
    middle, tail = rest.split("{summary}")
    none = F.lit("None")
    return F.concat(
        F.lit(head), F.coalesce(content, none), F.lit(middle), F.coalesce(summary, none),
        F.lit(tail),
    )


def is_denied(answer: Column) -> Column:
    """Whether a cleaned verdict says ``0``."""
    return F.lower(strip(F.regexp_replace(answer, r"[^a-zA-Z0-9\s]", ""))) == "0"


def json_first_extract(c: Column) -> Column:
    """``query.pages.<first id>.extract``; anything missing or malformed gives ``""``."""
    doc = F.from_json(c, "query struct<pages:map<string,struct<extract:string>>>")
    first = F.get(F.map_values(doc["query"]["pages"]), F.lit(0))
    return F.coalesce(first["extract"], F.lit(""))


def normalize_style(style, length, mapping=None, extender=None, threshold=100) -> Column:
    """Map a style label: exact hit in the mapping (with the extender on top for lengths over
    the threshold), else the words ``question`` / ``answer``, else unchanged."""

    def lookup(pairs):
        if not pairs:
            return F.lit(None).cast("string")
        table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
        return F.element_at(table, style)

    mapping, extender = mapping or {}, extender or {}
    exact = F.when(length > threshold, lookup({**mapping, **extender})).otherwise(lookup(mapping))
    by_word = (
        F.when(F.contains(style, F.lit("question")), F.lit("question"))
        .when(F.contains(style, F.lit("answer")), F.lit("answer"))
        .otherwise(style)
    )
    return F.coalesce(exact, by_word)
