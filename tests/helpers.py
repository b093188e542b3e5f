"""Small test inputs: log messages as JSON-line files, oldest first."""

import os
import time

from cadence.functions import to_json_row
from cadence.schemas import LOG_SCHEMA


def write_replay_files(history, path: str, n_files: int) -> None:
    """The (small) history's messages in time order, dealt to files that a file stream takes in this order."""
    cols = [f.name for f in LOG_SCHEMA.fields]
    lines = [r.value for r in history.orderBy("ts").select(to_json_row(*cols).alias("value")).collect()]
    os.makedirs(path, exist_ok=True)
    step = -(-len(lines) // n_files)
    for i in range(n_files):
        name = os.path.join(path, f"part-{i:05d}.txt")
        with open(name, "w") as f:
            f.write("\n".join(lines[i * step:(i + 1) * step]) + "\n")
        os.utime(name, (time.time() - 100 + i,) * 2)
