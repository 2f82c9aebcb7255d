"""Chat formatting by token-level assembly.

Each turn's text is escaped, encoded by itself and set between reserved ids
that no text can produce, so no token ever spans a turn's edge and no text
can imitate a marker. Masks come from prefix sums over +1 where a stretch to
learn from begins and -1 where it ends. As text, the markers are control
strings; where a text holds one itself it is escaped, reversibly.

Template, per turn: ``[INST] text [/INST]`` (user), ``[SYS] text [/SYS]``
(system), ``[ANS] text </s>`` (assistant), ``[TURN] role [SEP] text [/TURN]``
(any other role), without the blanks shown here; ``<s>`` opens the
conversation.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import quoted, shuffle_partitions

#: Control strings; their reserved ids follow the vocabulary in this order.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ANS]", "[TURN]", "[SEP]", "[/TURN]")
#: Opening and closing control of the roles with markers of their own.
MARKERS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[ANS]", "</s>")}
#: First reserved id: above every id of the 50k vocabularies.
RESERVED = 50_300
#: The role that is learned from.
LEARNED = "assistant"

_TAIL = r"(/?s>|/?INST\]|/?SYS\]|ANS\]|/?TURN\]|SEP\])"
_PLAIN = re.compile(r"([<\[])(\\*)" + _TAIL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _TAIL)


def escape(text: str) -> str:
    """A backslash more after the bracket of every control string, escaped
    ones included, so that :func:`unescape` is its exact inverse."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def load_encoding(path: str):
    """The byte-level vocabulary in a ``.tiktoken`` file of ranks; the split
    pattern is the one published with it."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if len(ranks) > RESERVED:
        raise ValueError("the vocabulary reaches into the reserved ids")
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def assemble(encoding, role: str, text: str, first: bool) -> tuple[list[int], np.ndarray, str]:
    """Ids, loss mask and formatted text of one turn."""
    ident = {c: RESERVED + k for k, c in enumerate(CONTROLS)}
    parts: list[tuple[str, bool, bool]] = [("<s>", True, False)] if first else []  # text, control?, learned?
    if role in MARKERS:
        before, after = MARKERS[role]
        parts += [(before, True, False), (escape(text), False, role == LEARNED), (after, True, False)]
    else:
        parts += [("[TURN]", True, False), (escape(role), False, False), ("[SEP]", True, False)]
        parts += [(escape(text), False, False), ("[/TURN]", True, False)]
    ids, edges = [], []
    for own, control, learned in parts:
        start = len(ids)
        ids += [ident[own]] if control else encoding.encode_ordinary(own)
        if learned:
            edges += [(start, 1), (len(ids), -1)]
    steps = np.zeros(len(ids) + 1, np.int8)
    for at, step in edges:
        steps[at] += step
    return ids, np.cumsum(steps[:-1], dtype=np.int8), "".join(own for own, _, _ in parts)


def format_chats(
    chats: DataFrame,
    vocabulary: str | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn, in its conversation's order: ``conv_id, place``
    (from 0), ``token_ids, loss_mask`` (arrays of equal length, 1 over the
    assistant's text) and ``formatted``. A conversation's sequence is its
    turns' one after the other.

    Rows are dealt by conversation and sorted, and pass through one at a
    time, so a conversation may have any number of turns. Turns are ordered
    by ``turn``, NULL first, then by role and text, so ties and repeated
    rows have one order; every row is a turn. NULL role or text is empty;
    rows with a NULL conversation are one conversation. An empty table gives
    no rows; other columns are not read.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = chats.select(
        quoted(conv_col).cast("long").alias("conv_id"),
        quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition(shuffle_partitions(chats.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(vocabulary)
        last, place = object(), 0
        for batch in batches:
            convs = batch.column("conv_id").to_pylist()
            places, ids, masks, texts = [], [], [], []
            for conv, role, text in zip(
                convs, batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                place = place + 1 if conv == last else 0
                last = conv
                own, mask, formatted = assemble(encoding, role, text, place == 0)
                places.append(place)
                ids.append(own)
                masks.append(mask)
                texts.append(formatted)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(places, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(masks, pa.list_(pa.int8())),
                    pa.array(texts, pa.string()),
                ],
                ["conv_id", "place", "token_ids", "loss_mask", "formatted"],
            )

    return ordered.mapInArrow(
        turns, "conv_id long, place long, token_ids array<int>, loss_mask array<tinyint>, formatted string"
    )


def parse_turn(encoding, ids: np.ndarray) -> tuple[str, str]:
    """Role and text of one assembled turn."""
    cut = np.flatnonzero(ids >= RESERVED)
    marks = [CONTROLS[k] for k in (ids[cut] - RESERVED).tolist()]
    texts = [encoding.decode(ids[a + 1 : b].tolist()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    if marks[0] == "<s>":
        marks, texts = marks[1:], texts[1:]
    if marks[0] == "[TURN]":
        return unescape(texts[0]), unescape(texts[1])
    return next(role for role, (before, _) in MARKERS.items() if before == marks[0]), unescape(texts[0])


def read_back(formatted: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per conversation, from :func:`format_chats` rows in their order:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``, all decoded from the ids and the mask. Digests are
    carried along the rows; no conversation is held whole."""
    vocabulary = vocabulary or default_vocabulary()

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(vocabulary)
        state = None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def closed(s):
            return [s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]]

        def batch_of(done):
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            done = []
            read = ("conv_id", "place", "token_ids", "loss_mask", "formatted")
            for conv, place, ids, mask, text in zip(*(batch.column(c).to_pylist() for c in read), strict=True):
                if place == 0:
                    if state:
                        done.append(closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, mask = np.asarray(ids), np.asarray(mask)
                role, own = parse_turn(encoding, ids)
                learned = unescape(encoding.decode(ids[mask == 1].tolist()))
                state[1] += 1
                state[2].update(f"{role}\n{own}\n".encode("utf-8", "surrogatepass"))
                state[3] += len(learned)
                state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield batch_of(done)
        if state:
            yield batch_of([closed(state)])

    return formatted.mapInArrow(
        conversations,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
