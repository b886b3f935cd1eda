"""A fixed public piece vocabulary: its pieces and scores, read once on each machine."""

from __future__ import annotations

import functools

#: Where the public tokenizers' files lie; a parameter of every operator that uses them.
TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
#: Marks the start of a word in pieces.
MARK = "▁"


@functools.lru_cache(maxsize=4)
def vocabulary(path: str = PIECE_MODEL) -> tuple[list[str], list[float]]:
    """Normal pieces with their scores, in the order of ids.

    Control, byte and unknown pieces are left out, and runs of word marks, which no word contains.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i) or model.id_to_piece(i).startswith(2 * MARK))]
    return [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids]


class Remembered(dict):
    """What a function gives for each word; emptied when it holds ``most`` words."""

    def __init__(self, of, most: int = 700_000) -> None:
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        found = self[word] = self.of(word)
        return found
