"""Classes and lower case of code points, as tables kept per Python worker."""

import numpy as np

from crawltable.llm.chars import kept_in_process
from crawltable.llm.tokens import LETTER, character_classes


def letter_table() -> np.ndarray:
    def make():
        table = character_classes() == LETTER
        table[[0x03A3, 0x03C2, 0x03C3]] = True
        return table

    return kept_in_process("letters", make)


def lower_table() -> np.ndarray:
    """Lower case of each code point that has one of a single character, else itself."""

    def make():
        table = np.arange(0x110000, dtype=np.uint32)
        for code in range(0x30000):
            if 0xD800 <= code <= 0xDFFF:
                continue
            lower = chr(code).lower()
            if len(lower) == 1:
                table[code] = ord(lower)
        return table

    return kept_in_process("lower", make)
