"""One hook for every model call.

A model is a function from a list of inputs to a list of results. Its factory runs once per
task, on the executor. Filters, samples and limits belong before the hook: Spark cannot push
them through Python. Write the hook's output (``stages.staged``) before using it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import TYPE_CHECKING, Any

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pyarrow as pa

ModelFactory = Callable[[], Callable[[list], list]]
TokenizerFactory = Callable[[], Callable[[list], list]]
SHARE_BYTES = 2 << 20


@dataclass(frozen=True)
class Retry:
    """A failing call is made ``attempts`` times in all, with growing waits (in seconds) between them.

    Errors of the ``permanent`` types are about the input: a call that ends in one is not repeated.
    """

    attempts: int = 5
    wait: float = 10.0
    growth: float = 2.0
    longest: float = 300.0
    permanent: tuple[type[Exception], ...] = (ValueError, TypeError, LookupError)

    def pause(self, tries: int) -> float:
        """The wait after so many calls."""
        return min(self.wait * self.growth ** (tries - 1), self.longest)


@dataclass(frozen=True)
class TokenBudget:
    """At most ``size`` tokens of a prompt.

    ``tokenizer`` is a factory, run once per task, of a function from a list of texts to
    a list of lists: the places (in characters) where each text's tokens end. So a text is
    cut at a token's end, whatever the tokenizer.
    """

    size: int
    tokenizer: TokenizerFactory

    def cut(self, texts: list, ends_of: Callable[[list], list]) -> tuple[list, list]:
        """The texts within the budget and how many tokens each has without it; null stays null."""
        known = [t for t in texts if t is not None]
        ends = iter(ends_of(known) if known else [])
        kept, counts = [], []
        for text in texts:
            own = next(ends) if text is not None else None
            counts.append(None if own is None else len(own))
            kept.append(text if own is None or len(own) <= self.size else text[: own[self.size - 1] if self.size else 0])
        return kept, counts


def shares(batch: pa.RecordBatch, limit: int = SHARE_BYTES) -> Iterator[pa.RecordBatch]:
    """An Arrow batch in parts of neighbouring rows of at most so many bytes; a larger row comes alone.

    Arrow batches are bounded in rows, not in bytes. What a task holds as Python objects, prompts, tokens
    and results, is that of one part, whatever the length of the texts.
    """
    if len(batch) < 2 or batch.nbytes <= limit:
        yield batch
    else:
        half = len(batch) // 2
        yield from shares(batch.slice(0, half), limit)
        yield from shares(batch.slice(half), limit)


def length_batches(lengths: list[int], batch_size: int, padded: int | None) -> Iterator[list[int]]:
    """Places of the inputs of each batch.

    With ``padded``, inputs are taken in order of length and a batch has at most so many cells: its
    inputs times the longest of them. A longer input comes alone.
    """
    order = list(range(len(lengths)))
    if padded is None:
        yield from (order[at : at + batch_size] for at in range(0, len(order), batch_size))
        return
    order.sort(key=lengths.__getitem__)
    batch: list[int] = []
    for at in order:  # ascending, so the newest is the longest
        if batch and (len(batch) == batch_size or (len(batch) + 1) * lengths[at] > padded):
            yield batch
            batch = []
        batch.append(at)
    if batch:
        yield batch


def run_model(
    df: DataFrame,
    inputs: str | Sequence[str],
    out_col: str,
    make_model: ModelFactory,
    batch_size: int = 16,
    out_type: str = "string",
    error_col: str | None = None,
    partitions: int | None = None,
    skip_null: bool = False,
    retry: Retry | None = None,
    attempts_col: str | None = None,
    budget: TokenBudget | None = None,
    tokens_col: str | None = None,
    padded: int | None = None,
    keep_inputs: bool = True,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``out_col`` with the model's result for each row.

    One input column gives the model plain values, several give tuples. Columns are handed
    through as Arrow; only the inputs become Python objects, a few MB of a batch at a time (``shares``).

    * ``error_col`` keeps rows whose call fails, alone and after its batch failed, with the
      message; without it the task fails and Spark retries it. If the table has the column
      already, from an earlier stage, rows with an error in it pass by the model and keep it.
    * ``retry`` repeats calls that fail for a passing reason; ``attempts_col`` says how many
      calls a row was in.
    * ``budget`` cuts the (first) input to a number of tokens; ``tokens_col`` is how many it had.
    * ``padded`` makes batches of inputs of like length, in tokens with a budget and in
      characters without, within a share of an Arrow batch. The order of rows stays.
    * Without ``keep_inputs`` the input columns end in the hook: prompts that nobody reads again need not come back.
    * ``partitions`` deals the rows to so many shares of model workers; None keeps the
      input's partitions and shuffles nothing. ``profile`` asks for executors of another kind.
    * With ``skip_null`` rows whose (first) input is null are not shown to the model and get null.
    """
    columns = [inputs] if isinstance(inputs, str) else list(inputs)
    single = isinstance(inputs, str)
    result_type = T.StructType.fromDDL(f"v {out_type}")["v"].dataType
    schema = T.StructType([f for f in df.schema.fields if keep_inputs or f.name not in columns]).add(out_col, result_type)
    keep_errors = error_col is not None
    carried = keep_errors and error_col in df.columns
    if keep_errors and not carried:
        schema = schema.add(error_col, T.StringType())
    for extra in (attempts_col, tokens_col):
        schema = schema.add(extra, T.IntegerType()) if extra else schema

    def call(batches):
        import time

        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        arrow_type = to_arrow_type(result_type)
        model = make_model()
        ends_of = budget.tokenizer() if budget else None

        def ask(values: list, allowed: int) -> list[tuple[Any, str | None, int]]:
            """(result, error, calls) of each value."""
            tries = 0
            while True:
                tries += 1
                try:
                    results = list(model(values))
                    if len(results) != len(values):
                        raise ValueError(f"model gave {len(results)} results for {len(values)} inputs")
                    return [(r, None, tries) for r in results]
                except Exception as failure:  # noqa: BLE001 - the model is foreign code
                    passing = retry is not None and not isinstance(failure, retry.permanent)
                    if passing and tries < allowed:
                        time.sleep(retry.pause(tries))
                        continue
                    if not keep_errors:
                        raise
                    if len(values) == 1:
                        return [(None, f"{type(failure).__name__}: {failure}", tries)]
                    # Alone each has its own attempts, but one only if waiting did not help.
                    alone = 1 if passing else allowed
                    return [(r, e, tries + n) for v in values for r, e, n in ask([v], alone)]

        for batch in (share for whole in batches for share in shares(whole)):
            lists = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
            counts = None
            if budget:
                lists[0], counts = budget.cut(lists[0], ends_of)
            failed = batch.column(batch.schema.get_field_index(error_col)).to_pylist() if carried else [None] * len(batch)
            rows: list[Any] = lists[0] if single else list(zip(*lists))
            asked = [i for i, x in enumerate(lists[0]) if failed[i] is None and not (skip_null and x is None)]
            results, calls = [None] * len(rows), [0] * len(rows)
            sizes = [0] * len(asked)
            if padded is not None:
                sizes = [min(counts[i] or 0, budget.size) if counts else len(str(lists[0][i])) for i in asked]
            for places in length_batches(sizes, batch_size, padded):
                some = [asked[k] for k in places]
                for i, found in zip(some, ask([rows[i] for i in some], retry.attempts if retry else 1)):
                    results[i], failed[i], calls[i] = found
            arrays, names = list(batch.columns), list(batch.schema.names)
            if carried:
                arrays[names.index(error_col)] = pa.array(failed, pa.string())
            more = [(out_col, results, arrow_type)]
            more += [(error_col, failed, pa.string())] if keep_errors and not carried else []
            more += [(attempts_col, calls, pa.int32())] if attempts_col else []
            more += [(tokens_col, counts or [None] * len(rows), pa.int32())] if tokens_col else []
            for name, values, kind in more:
                arrays.append(pa.array(values, kind))
                names.append(name)
            if not keep_inputs:
                arrays, names = zip(*[(a, n) for a, n in zip(arrays, names) if n not in columns])
            yield pa.RecordBatch.from_arrays(list(arrays), names=list(names))

    if partitions:
        df = df.repartition(partitions)
    return df.mapInArrow(call, schema, profile=profile)


def cut_tokens(df: DataFrame, text_col: str, budget: TokenBudget, out_col: str, count_col: str) -> DataFrame:
    """Add the text within the budget and the number of its tokens without it; a null text has null for both."""
    schema = T.StructType(list(df.schema.fields)).add(out_col, T.StringType()).add(count_col, T.IntegerType())

    def cut(batches):
        import pyarrow as pa

        ends_of = budget.tokenizer()
        for batch in (share for whole in batches for share in shares(whole)):
            kept, counts = budget.cut(batch.column(batch.schema.get_field_index(text_col)).to_pylist(), ends_of)
            arrays = [*batch.columns, pa.array(kept, pa.string()), pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, out_col, count_col])

    return df.mapInArrow(cut, schema)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write once, read from then on: no model is called twice, no lost executor repeats it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pending(df: DataFrame, done: DataFrame, ids: str | Sequence[str]) -> DataFrame:
    """Rows whose ids are not in ``done``, for resuming; null ids match null ids."""
    names = [ids] if isinstance(ids, str) else list(ids)
    other = done.select(*[done[c].alias(f"_done_{k}") for k, c in enumerate(names)])
    match = None
    for k, c in enumerate(names):
        one = df[c].eqNullSafe(other[f"_done_{k}"])
        match = one if match is None else match & one
    return df.join(other, match, "left_anti")
