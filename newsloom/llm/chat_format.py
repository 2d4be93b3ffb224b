r"""Format conversations at the level of tokens.

Every turn is encoded on its own: a reserved id opens it, its content's tokens follow, a reserved id closes it. Reserved
ids lie above the tokenizer's, so no content can make one. For the text form the reserved ids read as control strings;
content in which such a string occurs gets backslashes in front of it, and loses them again when it is read back. The loss
mask marks the content of assistant turns: +1 where such content begins and -1 where it ends, summed up from the left.

Tokens stay in rows of one turn each, in the order of the conversation, so no conversation has to fit into memory: a
conversation is the chain of its rows. Steps that need the order run over partitions sorted by conversation and turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.texts import id_key, whole_text

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

#: The control strings of the template.
OPENERS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
#: Opens a turn of any other role; the role's name and NAME_END come before the content.
OTHER = "### Role: "
NAME_END = " ###: "
TURN_END = " </turn>\n"
CONTROLS = (*OPENERS.values(), OTHER, NAME_END, TURN_END)

#: In content, what could be read as control, without the white space around it.
_GUARDED = "|".join(re.escape(c.strip()) for c in CONTROLS)
#: Only the first backslash of a run begins a match, so a long run is looked at once.
_TO_ESCAPE = re.compile(rf"(?<!\\)(\\*)({_GUARDED})")
_ESCAPED = re.compile(rf"(?<!\\)(\\+)({_GUARDED})")

TURN_COLUMNS = "conv_id long, turn long, role string, text string"
TOKEN_COLUMNS = "conv_id long, turn long, role string, text string, n_tokens int, input_ids array<int>, " \
                "loss_mask array<boolean>"


def escape(text: str) -> str:
    r"""Double the backslashes right before a control string and add one; others stay. `\</turn>` -> `\\\</turn>`."""
    return _TO_ESCAPE.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


class Template:
    """A tokenizer with reserved ids above its own."""

    def __init__(self, tokenizer: str = TOKENIZER):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.encode_special_tokens = True
        base = self.tokenizer.get_vocab_size()
        self.ids = {control: base + i for i, control in enumerate(CONTROLS)}
        self.controls = {i: control for control, i in self.ids.items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch([escape(t) for t in texts], add_special_tokens=False)]

    def content(self, ids: list[int]) -> str:
        """Escaped text of tokens between reserved ids."""
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def assemble(self, role: str, content: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of one turn."""
        if role in OPENERS:
            head = [self.ids[OPENERS[role]]]
        else:
            head = [self.ids[OTHER], *self.encode([role])[0], self.ids[NAME_END]]
        ids = np.array([*head, *content, self.ids[TURN_END]], dtype=np.int32)
        steps = np.zeros(len(ids) + 1, dtype=np.int32)
        if role == "assistant":
            steps[len(head)] += 1
            steps[len(head) + len(content)] -= 1
        return ids, np.cumsum(steps)[:-1] > 0


def encode_turns(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(conv_id, turn, role, text) rows with n_tokens, input_ids and loss_mask; each row on its own, without a shuffle."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template = Template(tokenizer)
        for rows in batches:
            made = [template.assemble(role, ids)
                    for role, ids in zip(rows["role"], template.encode(rows["text"].tolist()), strict=True)]
            yield rows.assign(n_tokens=[len(ids) for ids, _ in made], input_ids=[ids for ids, _ in made],
                              loss_mask=[mask for _, mask in made])

    return turns.mapInPandas(encode, TOKEN_COLUMNS)


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each turn: conv_id, position, token_start, n_tokens, input_ids, loss_mask.

    Turns go by number, nulls first; ties go by role, then text; repeated rows are turns of their own. A null text is
    empty; a null role is an empty name; rows without a conversation id form one conversation with the smallest id; an
    empty table gives no rows; other columns are left out.
    """
    rows = turns.select(
        id_key(F.col(conv_col)).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), whole_text(F.col(text_col)).alias("text"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    encoded = encode_turns(rows, tokenizer)
    before = F.sum("n_tokens").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return encoded.select(
        "conv_id", F.row_number().over(in_order).alias("position"),
        F.coalesce(before, F.lit(0)).cast("long").alias("token_start"), "n_tokens", "input_ids", "loss_mask")


DIGEST_COLUMNS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, " \
                 "formatted_chars long, n_tokens long"


class _Reader:
    """Reads one conversation's chain of ids back, keeping only digests and the turn it is in."""

    def __init__(self, conv_id: int, template: Template):
        self.conv_id, self.template = conv_id, template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.n_tokens = 0
        self.role, self.held, self.masked = "", [], []

    def add(self, ids: np.ndarray, mask: np.ndarray) -> None:
        controls = self.template.controls
        cuts = np.flatnonzero(ids >= min(controls))
        begin = 0
        for cut in cuts:
            self.held += ids[begin:cut].tolist()
            self.masked += ids[begin:cut][mask[begin:cut]].tolist()
            self._control(controls[int(ids[cut])])
            begin = cut + 1
        self.held += ids[begin:].tolist()
        self.masked += ids[begin:][mask[begin:]].tolist()
        self.n_tokens += len(ids)

    def _control(self, control: str) -> None:
        text = self.template.content(self.held)
        self.formatted_chars += len(text) + len(control)
        if control == NAME_END:
            self.role = unescape(text)
        elif control == TURN_END:
            self.n_turns += 1
            self.turns.update(f"{self.role}\n{unescape(text)}\n".encode())
            learned = unescape(self.template.content(self.masked))
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        else:
            self.role = next((role for role, opener in OPENERS.items() if opener == control), "")
        self.held, self.masked = [], []

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars, self.n_tokens)


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row for each conversation, read from its ids and mask alone: turns, text under the mask, lengths."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template, reader = Template(tokenizer), None
        columns = [c.split()[0] for c in DIGEST_COLUMNS.split(", ")]
        for rows in batches:
            done = []
            for conv_id, ids, mask in zip(rows["conv_id"], rows["input_ids"], rows["loss_mask"], strict=True):
                if reader is None or reader.conv_id != conv_id:
                    done += [reader.row()] if reader else []
                    reader = _Reader(conv_id, template)
                reader.add(np.asarray(ids), np.asarray(mask, dtype=bool))
            yield pd.DataFrame(done, columns=columns)
        yield pd.DataFrame([reader.row()] if reader else [], columns=columns)

    chained = formatted.select("conv_id", "position", "input_ids", "loss_mask") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return chained.mapInPandas(read, DIGEST_COLUMNS)
