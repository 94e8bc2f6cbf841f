"""Run a job from the shell: python -m tallywork JOB name=value ...

Results are shown, or saved where ``out=FOLDER`` is given (``fmt=`` parquet, csv or json; parquet by default). Streams
go on until stopped: to the console, or to a table in ``out=FOLDER``; with ``checkpoint=FOLDER`` a restarted stream goes on where it
was. With ``watermark=`` only windows that are closed come out, each once.
"""

from __future__ import annotations

import inspect
import sys

from tallywork.plans import jobs
from tallywork.session import build_session
from tallywork.sinks import AppendStream, TableStream, save, start_stream

JOBS = {
    name: job
    for name, job in inspect.getmembers(jobs, inspect.isfunction)
    if job.__module__ == jobs.__name__ and not name.startswith("_")
}


def settings_of(job, words: list[str]) -> dict[str, object]:
    """``name=value`` words as keyword arguments of the types the job declares."""
    settings: dict[str, object] = {}
    for word in words:
        name, _, value = word.partition("=")
        kind = inspect.signature(job).parameters[name].annotation
        if kind == "int":
            settings[name] = int(value)
        elif kind == "float":
            settings[name] = float(value)
        elif kind == "bool":
            settings[name] = value.lower() in ("1", "true", "yes")
        else:
            settings[name] = value
    return settings


def main(words: list[str]) -> None:
    if not words or words[0] not in JOBS:
        sys.exit(f"usage: python -m tallywork JOB name=value ...\njobs: {', '.join(sorted(JOBS))}")
    job = JOBS[words[0]]
    own = dict(w.split("=", 1) for w in words[1:] if w.partition("=")[0] in ("out", "fmt", "checkpoint"))
    rest = [w for w in words[1:] if w.partition("=")[0] not in own]
    result = job(build_session(), **settings_of(job, rest))
    if result.isStreaming:
        bounded = "watermark" in dict(w.split("=", 1) for w in rest)
        if "out" in own:
            sink = AppendStream if bounded else TableStream
            query = sink(result, "counts", own["out"], own.get("checkpoint")).query
        else:
            mode = "append" if bounded else "complete"
            query = start_stream(result, "counts", output_mode=mode, checkpoint=own.get("checkpoint"))
        query.awaitTermination()
    elif "out" in own:
        save(result, own["out"], fmt=own.get("fmt", "parquet"))
    else:
        result.show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
