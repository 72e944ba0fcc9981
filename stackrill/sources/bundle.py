"""Configurations and model bundles: YAML, and zip files of models with their metadata."""

from __future__ import annotations

import copy
import datetime
import io
import posixpath
import zipfile
from pathlib import Path
from typing import Any

import yaml


class Config(dict):
    """A dict whose keys are attributes too; nested dicts alike."""

    def __getattr__(self, name: str) -> Any:
        try:
            return self[name]
        except KeyError:
            raise AttributeError(name) from None

    def __setattr__(self, name: str, value: Any) -> None:
        self[name] = value


def as_config(value: Any) -> Any:
    if isinstance(value, dict):
        return Config({k: as_config(v) for k, v in value.items()})
    return [as_config(v) for v in value] if isinstance(value, list) else value


def read_config(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return as_config(yaml.safe_load(f) or {})


def update_config(base: dict, changes: dict) -> dict:
    """A deep copy of ``base`` with ``changes`` put in, dict by dict."""
    out = copy.deepcopy(base)
    for k, v in changes.items():
        out[k] = update_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def tracker_config(path: str, overrides: dict | None = None) -> dict:
    """Tracker settings of a YAML file, or of the first one in a zip, with shallow overrides."""
    if str(path).endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            name = next((n for n in sorted(z.namelist()) if n.endswith((".yml", ".yaml"))), None)
            if name is None:
                raise ValueError(f"no YAML file in {path}")
            found = yaml.safe_load(z.read(name))
    else:
        found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return {**(found or {}), **(overrides or {})}


def safe_extract(archive: str | bytes, folder: str) -> list[str]:
    """Extract a zip; a member that would leave the folder raises before anything is written."""
    root = Path(folder).resolve()
    with zipfile.ZipFile(io.BytesIO(archive) if isinstance(archive, bytes) else archive) as z:
        for n in z.namelist():
            if posixpath.isabs(n) or not (root / n).resolve().is_relative_to(root):
                raise ValueError(f"Unsafe path in archive: {n}")
        z.extractall(root)
        return z.namelist()


def write_bundle(info: str | dict, out: str, add_date: bool = False) -> str:
    """A bundle of the models that a YAML file lists: name -> {model_path, [model_metadata], ...}.

    Holds models/, metadata/ and a config.yml whose paths are within the bundle. Returns its path.
    """
    listed = read_config(info) if isinstance(info, str) else info
    base = Path(info).parent if isinstance(info, str) else Path()
    if add_date:
        p = Path(out)
        out = str(p.with_name(f"{p.stem}_{datetime.date.today():%Y%m%d}{p.suffix or '.zip'}"))
    config: dict[str, Any] = {"_bundle_metadata": {"created": datetime.datetime.now().isoformat(timespec="seconds"), "models": sorted(k for k in listed if not k.startswith("_"))}}
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, entry in listed.items():
            if name.startswith("_") or not isinstance(entry, dict):
                continue
            entry = dict(entry)
            for key, folder in (("model_path", "models"), ("model_metadata", "metadata")):
                if entry.get(key):
                    file = base / entry[key]
                    if not file.exists():
                        raise FileNotFoundError(str(file))
                    entry[key] = f"{folder}/{name}{file.suffix}"
                    z.write(file, entry[key])
            config[name] = entry
        z.writestr("config.yml", yaml.safe_dump(config))
    return out


def read_bundle(path: str, folder: str, required: list[str] | None = None) -> Config:
    """Extract a bundle and return its config, of the required models only, with full paths."""
    safe_extract(path, folder)
    config = read_config(str(Path(folder) / "config.yml"))
    names = [n for n in config if not n.startswith("_") and (required is None or n in required)]
    if missing := sorted(set(required or ()) - set(names)):
        raise ValueError(f"models missing from the bundle: {', '.join(missing)}")
    out = Config()
    for n in names:
        out[n] = Config({k: str(Path(folder) / v) if k in ("model_path", "model_metadata") and v else v for k, v in config[n].items()})
    return out
