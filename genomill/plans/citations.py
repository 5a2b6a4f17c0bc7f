"""Source citations: bundles of studies and archive accessions that a report shows."""

from __future__ import annotations

import os
import re
from pathlib import Path

#: Pages of accessions by their kind, and prefixes of a DOI (fixed values).
PAGES = {"bioproject": "https://www.ncbi.nlm.nih.gov/bioproject/{}", "sra_run": "https://www.ncbi.nlm.nih.gov/sra/{}"}
DOI_PREFIX = re.compile(r"(?i)^(https?://doi\.org/|doi:)")
FOLDER = "configs/citations"
_FIELDS = ("key", "label", "study", "accession", "accession_kind", "doi", "url", "used_for", "access")


def source(raw: dict) -> dict:
    """One source with all its fields, its DOI bare, and ``link``: its address, else its DOI's,
    else its accession's page."""
    if missing := [f for f in ("key", "label") if not raw.get(f)]:
        raise ValueError(f"a source has no {' and no '.join(missing)}")
    out = {f: str(raw.get(f) or "").strip() for f in _FIELDS} | {"year": raw.get("year")}
    out["doi"] = DOI_PREFIX.sub("", out["doi"])
    page = PAGES.get(out["accession_kind"], "").format(out["accession"]) if out["accession"] else ""
    out["link"] = out["url"] or (f"https://doi.org/{out['doi']}" if out["doi"] else page)
    return out


def find(name: str, roots: list[str]) -> Path:
    """A bundle by path, or by its bare name in ``configs/citations`` of a root."""
    path = Path(name)
    tried = [path] if path.is_absolute() else [Path(r) / (path if path.suffix else Path(FOLDER) / f"{name}.yaml") for r in roots]
    for p in tried:
        if p.exists():
            return p
    raise ValueError(f"no citation bundle {name}; looked at {', '.join(map(str, tried))}")


def load(names: list[str], root: str = ".") -> list[dict]:
    """The bundles (id, label, description, sources), each once, in the order named."""
    import yaml

    out: dict[str, dict] = {}
    for name in names:
        path = find(name, list(dict.fromkeys([root, os.getcwd()])))
        raw = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        if not isinstance(raw, dict) or not raw.get("id") or not raw.get("label"):
            raise ValueError(f"{path}: a bundle is a mapping with id and label")
        out.setdefault(raw["id"], {"id": raw["id"], "label": raw["label"], "description": raw.get("description", ""), "sources": [source(s) for s in raw.get("sources") or []]})
    return list(out.values())


def rows(bundles: list[dict]) -> list[dict]:
    """A row for each source, with its bundle's label as ``dataset``."""
    return [{"dataset": b["label"], **s} for b in bundles for s in b["sources"]]
