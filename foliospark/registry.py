"""Named parts of the pipeline. A configuration names them; ``register`` adds one of one's own, or replaces a built-in one.

* chunkers: f(documents, key, text, size, overlap) -> (key, chunk_index, page_number, section, text)
* embedders: f(width) -> a function from texts to vectors, in order
* summarisers: a function from a text to a summary
* generators: f(instructions, prompt) -> an iterator of the answer's pieces
* stores: a class with the methods of ``operators.store.TableStore``
* auditors: a function from a file's bytes to a mapping of measurements, by extension
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from .operators import chunking
from .operators.store import TableStore
from .sources import epub, pdf

PARTS: dict[str, dict[str, Any]] = {
    "chunkers": {"markdown": chunking.chunk_markdown, "fixed": chunking.chunk_fixed},
    "embedders": {},
    "summarisers": {"head": lambda text: text[:300]},
    "generators": {"echo": lambda instructions, prompt: iter(prompt.splitlines(True))},
    "stores": {"table": TableStore},
    "auditors": {"epub": epub.audit, "pdf": pdf.audit},
}


def register(kind: str, name: str, part: Callable) -> None:
    """Adds a part under a name, in place of one that has it."""
    PARTS[_known(kind)][name] = part


def lookup(kind: str, name: str) -> Any:
    """The part of a name; an unknown name is an error that lists the known ones."""
    parts = PARTS[_known(kind)]
    if name not in parts:
        raise ValueError(f"no {kind[:-1]} {name!r}; there are: {', '.join(sorted(parts)) or 'none'}")
    return parts[name]


def _known(kind: str) -> str:
    if kind not in PARTS:
        raise ValueError(f"no such kind of part: {kind!r}")
    return kind
