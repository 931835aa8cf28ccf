"""Helpers of the tests."""

import io
import json
import tarfile
from pathlib import Path


def rows(df, *cols):
    """Rows as sorted tuples, nulls last."""
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=lambda t: tuple((x is None, str(type(x)) if x is None else "", x if x is not None else 0) for x in t))


def make_chunk(folder, name, bodies, *, fetched="2026-09-29T10:24:00+00:00", broken=False, probes=None):
    """An archive of one poll; ``bodies`` maps endpoints to objects or texts."""
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    if broken:
        path.write_bytes(b"no archive at all")
        return path
    meta = {"endpoints": {e: {"status": 200, "ok": True, "attempts": 1, "bytes": 10, "elapsed_s": 0.5, "fetched_at_utc": fetched, "error": None} for e in bodies}, "probes": probes or {}}
    with tarfile.open(path, "w:gz") as tar:
        for member, content in {"meta.json": meta, **{f"raw/{e}.json": b for e, b in bodies.items()}}.items():
            raw = (content if isinstance(content, str) else json.dumps(content, ensure_ascii=False)).encode()
            info = tarfile.TarInfo(member)
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
    return path
