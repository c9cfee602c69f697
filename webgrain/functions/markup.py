"""A linear scanner for markup as it is found: broken tags, sections and comments are passed over,
never an error."""

import html
import re
from collections.abc import Iterator

# a start or end tag; quoted values may hold ">". A stray "<" ends the attempt, so that no part of
# the text is scanned again and again.
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|</?([a-zA-Z][^\s/<>]*)([^<>]*)>")
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
RAW = frozenset(["script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"])
_NO_TEXT = frozenset(["script", "style", "xmp", "iframe", "noembed", "noframes"])


def attributes(source: str) -> dict[str, str]:
    """Names in lower case; of two equal ones the last counts."""
    found = {}
    for name, a, b, c in _ATTR.findall(source):
        found[name.lower()] = html.unescape(a or b or c)
    return found


def scan(source: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or content, attribute source) in order, with kind ``open``, ``close``, ``text``,
    ``raw`` (inside scripts, styles and the like), ``cdata`` or ``note`` (comments, declarations,
    instructions and other marked sections, closed or not).

    The content of raw elements reaches up to their end tag or the end of the page. Texts are
    decoded, raw ones and notes are not.
    """
    at, size = 0, len(source)
    lower = None
    gone = {}  # end marks that do not come again
    while at < size:
        lt = source.find("<", at)
        if lt < 0:
            yield "text", html.unescape(source[at:]), ""
            return
        if lt > at:
            yield "text", html.unescape(source[at:lt]), ""
        nxt = source[lt + 1:lt + 2]
        if nxt in ("!", "?"):
            mark = "-->" if source.startswith("<!--", lt) else ">"
            end = -1 if gone.get(mark) else source.find(mark, lt + (2 if mark == ">" else 4))
            if end < 0 and mark == "-->":
                gone[mark] = True
                mark, end = ">", (-1 if gone.get(">") else source.find(">", lt))
            if end < 0:
                gone[">"] = True
                yield "note", source[lt + 2:], ""
                return
            if mark == "-->":
                yield "note", source[lt + 4:end], ""
            elif source.startswith("<![CDATA[", lt):
                stop = source.find("]]>", lt)
                end, mark = (stop, "]]>") if stop >= 0 else (end, mark)
                yield "cdata", source[lt + 9:end], ""
            else:
                yield "note", source[lt + 2:end], ""
            at = end + len(mark)
            continue
        m = None if gone.get(">") else _TAG.match(source, lt)
        if m is None:
            if (nxt.isalpha() or nxt == "/") and source.find(">", lt) < 0:
                return  # an unfinished tag at the end
            if nxt == "/" or nxt.isalpha():
                # a broken tag ends where the next one starts
                stop = source.find("<", lt + 1)
                if nxt == "/" and not source[lt + 2:lt + 3].isalpha():
                    stop = source.find(">", lt) + 1
                at = stop if stop > lt else size
            else:
                yield "text", "<", ""
                at = lt + 1
            continue
        at = m.end()
        name = (m[1] or m[3]).lower()
        if source[lt + 1] == "/":
            yield "close", name, ""
            continue
        yield "open", name, m[2] or m[4] or ""
        if name in RAW:
            if lower is None:
                lower = source.lower()
                if len(lower) != size:  # a few letters change their length
                    lower = re.sub("[A-Z]+", lambda x: x[0].lower(), source)
            end = lower.find(f"</{name}", at)
            end = size if end < 0 else end
            if end > at:
                content = source[at:end]
                yield ("raw", content, "") if name in _NO_TEXT else ("text", html.unescape(content), "")
            at = end
