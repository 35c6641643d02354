"""Files of public vocabularies, opened once per Python worker."""

from __future__ import annotations

import os
import re
from functools import lru_cache

# Fixed value: up to here character classes, normal forms and lower case are the same in this
# Python and in the vocabularies' library.
LATIN = re.compile("[\0-\u024f]*")
CACHED_LENGTH = 64


def public_path(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Recent(dict):
    """Answers by text: two generations, the older one is dropped when the newer is full."""

    def __init__(self, work_out, size: int):
        super().__init__()
        self.work_out, self.size, self.older = work_out, size, {}

    def __missing__(self, text):
        answer = self.older.get(text)
        if answer is None:
            answer = self.work_out(text)
        if len(text) <= CACHED_LENGTH:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[text] = answer
        return answer


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next unused one."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]
