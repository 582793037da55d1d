"""Chat formatting by token-level assembly.

Every turn's role and text are encoded on their own, and control tokens are spliced
between them as reserved ids beyond the vocabulary: no text can produce one. The loss mask
is a prefix sum over the ids. The written-out form marks turns by control strings, so
those are escaped where they occur in a text.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import materialize, pick

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The split pattern that belongs to the public byte-level vocabulary above.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Reserved ids, counted from the first id beyond the vocabulary.
TURN, SPEAKS, TRAINED_SPEAKS, END = range(4)
#: The role whose texts bear the loss.
TRAINED_ROLE = "assistant"

# The template: how each reserved id is written out.
WRITTEN = {TURN: "### ", SPEAKS: ": ", TRAINED_SPEAKS: ": ", END: " </turn>\n"}
CONTROL = re.compile(r"\\|###|</turn>")
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
WRITTEN_TURN = re.compile(r"### ((?:\\.|[^\\])*?): ((?:\\.|[^\\])*?) </turn>\n", re.S)


def escape(text: str) -> str:
    """A backslash before each backslash and control string."""
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    """As ``escape``; a colon, which ends a role, is escaped too."""
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def parse_written(written: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of the written-out form."""
    return [(unescape(m[1]), unescape(m[2])) for m in WRITTEN_TURN.finditer(written)]


def load_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary file, read once on the driver and sent to the tasks (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def encoding(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encode(vocabulary):
    """Adds to each turn its ids, reserved ids included."""

    def run(batches):
        coder = encoding(vocabulary.value)
        base = coder.n_vocab
        for batch in batches:
            roles = coder.encode_ordinary_batch([escape_role(x) for x in batch.column("role").to_pylist()], num_threads=1)
            texts = coder.encode_ordinary_batch([escape(x) for x in batch.column("text").to_pylist()], num_threads=1)
            trained = [x == TRAINED_ROLE for x in batch.column("role").to_pylist()]
            ids = [
                [base + TURN, *role, base + (TRAINED_SPEAKS if t else SPEAKS), *text, base + END]
                for role, text, t in zip(roles, texts, trained, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("place"), pa.array(ids, pa.list_(pa.int32()))], ["conv_id", "place", "ids"]
            )

    return run


def loss_mask(ids: np.ndarray, base: int) -> np.ndarray:
    """1 for the text tokens of trained turns: a prefix sum that steps up behind their
    start and down at their end. ``ids`` may hold any number of whole turns."""
    starts = (ids == base + SPEAKS) | (ids == base + TRAINED_SPEAKS)
    trained = (ids == base + TRAINED_SPEAKS)[starts]
    step = np.zeros(len(ids) + 1, dtype=np.int64)
    step[np.flatnonzero(starts)[trained] + 1] += 1
    step[np.flatnonzero(ids == base + END)[trained]] -= 1
    return np.cumsum(step[:-1]).astype(np.int8)


def _mask(base: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("input_ids")
            mask = loss_mask(ids.flatten().to_numpy(), base)
            bounds = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
            masks = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(mask, pa.int8()))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), ids, masks], ["conv_id", "input_ids", "loss_mask"])

    return run


def format_chats(turns: DataFrame, vocabulary: bytes) -> DataFrame:
    """One row per conversation: conv_id, input_ids (array of int), loss_mask (array of
    tinyint, of the same length).

    ``turns`` has conv_id, turn, role and text. Rows go by turn (null first), rows of the
    same turn by role and text, so repeated rows are repeated turns. A null role or text is
    empty, a null conv_id is one conversation, an unknown role is encoded like any other.
    An empty table gives no conversation. Turns are encoded before the shuffle, one row
    each; a conversation is one output row and has to fit a task."""
    coder = encoding(vocabulary)
    sent = turns.sparkSession.sparkContext.broadcast(vocabulary)
    turns = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    place = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), F.xxhash64(text).alias("text"))
    encoded = turns.select(F.col("conv_id").cast("long").alias("conv_id"), place.alias("place"), role.alias("role"), text.alias("text")).mapInArrow(
        _encode(sent), "conv_id long, place struct<turn: long, role: string, text: long>, ids array<int>"
    )
    grouped = encoded.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "ids"))).alias("turns"))
    return grouped.select("conv_id", F.flatten(F.col("turns.ids")).alias("input_ids")).mapInArrow(
        _mask(coder.n_vocab), "conv_id long, input_ids array<int>, loss_mask array<tinyint>"
    )


def read_turns(ids: np.ndarray, mask: np.ndarray, coder: tiktoken.Encoding) -> tuple[list[tuple[str, str]], str, str]:
    """(role, text) of each turn, the text under the loss mask, and the written-out form,
    all read back from one conversation's ids and mask."""
    base, said = coder.n_vocab, lambda x: coder.decode_bytes(x.tolist()).decode()
    turns, trained, written, at = [], [], [], 0
    for end in np.flatnonzero(ids == base + END):
        speaks = at + int(np.flatnonzero((ids[at:end] == base + SPEAKS) | (ids[at:end] == base + TRAINED_SPEAKS))[0])
        role, text = said(ids[at + 1 : speaks]), said(ids[speaks + 1 : end])
        turns.append((unescape(role), unescape(text)))
        written += [WRITTEN[TURN], role, WRITTEN[SPEAKS], text, WRITTEN[END]]
        under = ids[speaks + 1 : end][mask[speaks + 1 : end] == 1]
        trained.append(unescape(said(under)))
        at = int(end) + 1
    return turns, "".join(trained), "".join(written)


def _read(vocabulary):
    def run(batches):
        import hashlib

        coder = encoding(vocabulary.value)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in batches:
            out = []
            for conv, ids, mask in zip(batch.column("conv_id").to_pylist(), batch.column("input_ids"), batch.column("loss_mask"), strict=True):
                turns, trained, written = read_turns(ids.values.to_numpy(), mask.values.to_numpy(), coder)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((conv, len(turns), sha(said), len(trained), sha(trained), len(written)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return run


def read_back(chats: DataFrame, vocabulary: bytes) -> DataFrame:
    """Per formatted conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, all computed from its ids and mask."""
    sent = chats.sparkSession.sparkContext.broadcast(vocabulary)
    return chats.select("conv_id", "input_ids", "loss_mask").mapInArrow(
        _read(sent), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def format_and_read(turns: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Format all conversations, write them, read the written rows back."""
    vocabulary = load_vocabulary(path)
    return read_back(materialize(format_chats(turns, vocabulary), "chats"), vocabulary)
