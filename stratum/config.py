"""Run settings passed explicitly to the plans."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field

# fixed values: batch id format and the open end of a version interval
BATCH_ID_FORMAT = "%Y%m%dT%H%M%SZ"
OPEN_END = "9999-12-31"


def new_batch_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime(BATCH_ID_FORMAT)


@dataclass(frozen=True)
class RunContext:
    """What one run needs to be reproducible: the day it describes, the salt and the batch id."""

    as_of: dt.date = field(default_factory=dt.date.today)
    salt: str = field(default_factory=lambda: os.environ.get("MASK_SALT", ""))
    batch_id: str = field(default_factory=new_batch_id)
    commit_sha: str | None = None
