"""Token loss masks and selective supervision, with an injected tokenizer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from kelpforge.functions.pynorm import edit_ranges

#: Renders the first n messages to ids: prefixes of one another.
Encode = Callable[[list[dict]], list[int]]
IGNORED = -100
_ROW = "id string, input_ids array<int>, attention_mask array<int>, labels array<int>, spans array<struct<message_index:int,role:string,trainable:boolean,start:int,end:int>>"


def loss_mask(messages: list[dict], encode: Encode) -> dict:
    """Ids, labels and spans; a message's span is what it adds to the rendering before it."""
    ids: list[int] = []
    spans = []
    for n, m in enumerate(messages):
        now = encode(messages[: n + 1])
        if now[: len(ids)] != ids:
            raise ValueError(f"the rendering of message {n} changes what stands before it")
        spans.append({"message_index": n, "role": m["role"], "trainable": bool(m.get("trainable")), "start": len(ids), "end": len(now)})
        ids = now
    labels = [IGNORED] * len(ids)
    for s in spans:
        if s["role"] == "assistant" and s["trainable"]:
            labels[s["start"] : s["end"]] = ids[s["start"] : s["end"]]
    return {"input_ids": ids, "attention_mask": [1] * len(ids), "labels": labels, "spans": spans}


def tokenize_episodes(episodes: DataFrame, make_encode: Callable[[], Encode]) -> DataFrame:
    """Token rows of episodes (id, messages); the tokenizer is made once in each worker."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encode()
        for pdf in batches:
            rows = [{"id": r.id, **loss_mask([m.asDict() if hasattr(m, "asDict") else dict(m) for m in r.messages], encode)} for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["id", "input_ids", "attention_mask", "labels", "spans"])

    return episodes.select("id", "messages").mapInPandas(work, _ROW)


def supervised_text(row: dict, decode: Callable[[list[int]], str]) -> str:
    """The text of the supervised tokens in order."""
    return decode([x for x in row["labels"] if x != IGNORED])


def token_weights(offsets: list[tuple[int, int]], labels: list[int], body: tuple[int, int], before: str | None, after: str, strategy: str = "full", inside: float = 1.0, outside: float = 0.1, context: int = 8) -> list[float]:
    """A weight for each token of a supervised action, by strategy.

    ``full``: all supervised tokens; ``wrapper``: those outside the code; ``delta``: the wrapper
    and what the code changes against the previous one; ``weighted``: changes at ``inside``,
    other code at ``outside``. ``body``: where the code stands, escaped, in the text.
    """
    if strategy not in ("full", "wrapper", "delta", "weighted"):
        raise ValueError(strategy)
    ranges = [(body[0] + a, body[0] + b) for a, b in edit_ranges(before or "", after, context)]
    out = []
    for (a, b), y in zip(offsets, labels):
        in_code = a < body[1] and b > body[0]
        changed = before is None or any(a < hi and b > lo for lo, hi in ranges)
        if y == IGNORED:
            out.append(0.0)
        elif strategy == "full" or not in_code:
            out.append(1.0)
        elif strategy == "wrapper":
            out.append(0.0)
        elif strategy == "delta":
            out.append(1.0 if changed else 0.0)
        else:
            out.append(inside if changed else outside)
    return out
