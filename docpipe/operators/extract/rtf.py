"""Rich Text Format bytes to text, after the public RTF specification (1.9.1).

Three steps, each a pass over a stream: split the source into tokens, drop the fallback
characters that follow a ``\\u``, and write what is left into the group it stands in.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

# Fixed values, from the specification's index of control words: destinations, that is groups
# whose content is not body text (header tables, information group, headers and footers,
# footnotes and annotations, index and contents entries, fields, objects and pictures).
DESTINATIONS = frozenset("""
    annotation atnauthor atndate atnicn atnid atnparent atnref atntime
    author buptim category colortbl comment company creatim
    datafield do doccomm docvar falt filetbl fontemb fontfile fonttbl
    footer footerf footerl footerr footnote ftncn ftnsep ftnsepc
    generator header headerf headerl headerr hlinkbase
    info keycode keywords listname listoverridetable listtable manager
    nextfile nonshppict objalias objclass objdata object objname objsect
    operator panose pict private printim propname revtbl revtim rsidtbl rxe
    shpinst staticval stylesheet subject tc template title txe userprops
    xe xmlnstbl
""".split())

# Fixed values, from the chapter on special characters.
CHARACTERS = {
    "par": "\n",
    "line": "\n",
    "sect": "\n\n",
    "page": "\n\n",
    "tab": "\t",
    "emdash": "\u2014",
    "endash": "\u2013",
    "emspace": "\u2003",
    "enspace": "\u2002",
    "qmspace": "\u2005",
    "bullet": "\u2022",
    "lquote": "\u2018",
    "rquote": "\u2019",
    "ldblquote": "\u201c",
    "rdblquote": "\u201d",
}
SYMBOLS = {"~": "\u00a0", "{": "{", "}": "}", "\\": "\\"}

OPEN, CLOSE, WORD, SYMBOL, TEXT = "open", "close", "word", "symbol", "text"


class Token(NamedTuple):
    kind: str
    value: str = ""
    number: int | None = None


# A control word takes an optional number and one blank; line ends are not text.
_SOURCE = re.compile(
    r"\\(?P<word>[A-Za-z]{1,32})(?P<number>-?\d{1,10})?[ ]?|\\'(?P<byte>[0-9A-Fa-f]{2})|\\(?P<symbol>[^A-Za-z])"
    r"|(?P<brace>[{}])|[\r\n]+|(?P<text>[^\\{}\r\n]+|\\)"
)


def tokens(source: str) -> Iterator[Token]:
    for found in _SOURCE.finditer(source):
        if found["word"]:
            yield Token(WORD, found["word"], found["number"] and int(found["number"]))
        elif found["byte"]:
            yield Token(TEXT, chr(int(found["byte"], 16)))
        elif found["symbol"]:
            yield Token(SYMBOL, found["symbol"])
        elif found["brace"]:
            yield Token(OPEN if found["brace"] == "{" else CLOSE)
        elif found["text"]:
            yield Token(TEXT, found["text"])


def without_fallbacks(stream: Iterator[Token]) -> Iterator[Token]:
    """Drop the characters that readers without Unicode would show for a ``\\u``.

    Their number is set by ``\\uc``, holds for the group and those in it, and is one at first.
    Anything but text ends them early.
    """
    lengths = [1]
    left = 0
    for token in stream:
        if token.kind == TEXT:
            shown = token.value[left:]
            left -= len(token.value) - len(shown)
            if shown:
                yield token._replace(value=shown)
            continue
        left = 0
        if token.kind == OPEN:
            lengths.append(lengths[-1])
        elif token.kind == CLOSE and len(lengths) > 1:
            lengths.pop()
        elif token.kind == WORD and token.value == "uc":
            lengths[-1] = 1 if token.number is None else token.number
        elif token.kind == WORD and token.value == "u":
            left = lengths[-1]
        yield token


class Group:
    """A group of the document and the text written in it so far."""

    def __init__(self, shown: bool) -> None:
        self.shown = shown
        self.parts: list[str] = []

    def write(self, text: str) -> None:
        if self.shown:
            self.parts.append(text)

    def hide(self, _: int | None = None) -> None:
        self.shown = False

    def unicode(self, code: int | None) -> None:
        if self.shown:
            if code is None:
                raise ValueError("a \\u without a number")
            self.write(chr(code % 0x10000 if code < 0 else code))


# What a control word does to its group; words that are not listed do nothing to the text.
WORDS: dict[str, Callable[[Group, int | None], None]] = (
    dict.fromkeys(DESTINATIONS, Group.hide)
    | {word: lambda group, _, text=text: group.write(text) for word, text in CHARACTERS.items()}
    | {"u": Group.unicode}
)


def read_rtf(content: bytes) -> list[str]:
    """Body text. Malformed input (not UTF-8, empty, a ``}`` too many) raises."""
    source = content.decode("utf-8")
    if not source:
        raise ValueError("no rtf content")
    nested = [Group(shown=True)]  # the whole file, then every group that is open
    for token in without_fallbacks(tokens(source)):
        here = nested[-1]
        if token.kind == OPEN:
            nested.append(Group(here.shown))
        elif token.kind == CLOSE:
            nested.pop()
            if not nested:
                raise ValueError("unbalanced group end")
            nested[-1].parts += here.parts
        elif token.kind == TEXT:
            here.write(token.value)
        elif token.kind == SYMBOL and token.value == "*":
            here.hide()
        elif token.kind == SYMBOL:
            here.write(SYMBOLS.get(token.value, ""))
        elif token.value in WORDS:
            WORDS[token.value](here, token.number)
    text = "".join(part for group in nested for part in group.parts)
    # two \u words can carry the halves of one character
    return [text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")]
