"""Cutting text where byte-level tokenizers always cut, so that results can be reused.

A single space between two characters that are not white space always starts a new match of
the tokenizers' split pattern. Texts whose spaces all stand like that fall into chunks at
their spaces; each chunk is tokenized on its own, and repeated chunks only once.
"""

from __future__ import annotations

import re

# A space beside other white space (a superset of every engine's notion of it).
_UNSAFE = re.compile(r" (?:\s|(?<=\s ))")


def cuts_at_spaces(text: str) -> bool:
    """Whether all spaces of the text stand between characters that are no white space, so that
    each starts a new match."""
    return not _UNSAFE.search(text)
