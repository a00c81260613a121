"""Model artefacts: a model's parameters beside a manifest that says what they are and proves that they are unchanged."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import uuid

import numpy as np
import pyspark
from pyspark.sql import SparkSession

from ..operators import trees
from .runs import RunExists, _exists, _fs, _put, _text


class ArtifactChanged(ValueError):
    """The artefact isn't what its manifest describes, or not what is asked for."""


def _plain(forest: trees.Forest) -> dict:
    tree = lambda t: {"feature": t.feature.tolist(), "right": ["".join("01"[int(b)] for b in row) for row in t.right], "leaf": t.leaf.tolist()}
    return {
        "names": forest.names, "categories": forest.categories, "edges": forest.edges, "params": dataclasses.asdict(forest.params), "start": list(forest.start),
        "trees": [[tree(t) for t in r] for r in forest.trees], "gain": forest.gain,
    }


def _forest(held: dict) -> trees.Forest:
    tree = lambda t: trees.Tree(np.array(t["feature"]), np.array([[c == "1" for c in row] for row in t["right"]]), np.array(t["leaf"]))
    return trees.Forest(held["names"], held["categories"], held["edges"], trees.Params(**held["params"]), held["start"], [[tree(t) for t in r] for r in held["trees"]], held["gain"])


def save(spark: SparkSession, path: str, forest: trees.Forest, protocol: str, trained_until: str, code_version: str = "unknown") -> dict:
    """Write a model and its manifest, which is returned. A path that is taken raises; a model that is there is whole."""
    if _exists(spark, path):
        raise RunExists(path)
    text = json.dumps(_plain(forest), sort_keys=True)
    manifest = {
        "sha256": hashlib.sha256(text.encode()).hexdigest(), "features": forest.names, "heads": forest.heads, "protocol": protocol, "trained_until": trained_until,
        "code_version": code_version, "spark": pyspark.__version__,
    }
    beside = f"{path}-{uuid.uuid4().hex}"
    _put(spark, f"{beside}/model.json", text)
    _put(spark, f"{beside}/manifest.json", json.dumps(manifest, sort_keys=True))
    fs, p = _fs(spark, beside)
    if not fs.rename(p, _fs(spark, path)[1]):
        raise OSError(f"could not move the model to {path}")
    return manifest


def load(spark: SparkSession, path: str, features: list[str] | None = None, protocol: str | None = None) -> tuple[trees.Forest, dict]:
    """A model and its manifest. Raises if its parameters were changed, its features or protocol aren't those asked for, or
    it was made under another major version of Spark."""
    manifest, text = json.loads(_text(spark, f"{path}/manifest.json")), _text(spark, f"{path}/model.json")
    if hashlib.sha256(text.encode()).hexdigest() != manifest["sha256"]:
        raise ArtifactChanged(f"{path}: the model differs from its manifest")
    if features is not None and features != manifest["features"]:
        raise ArtifactChanged(f"{path}: made for the features {manifest['features']}")
    if protocol is not None and protocol != manifest["protocol"]:
        raise ArtifactChanged(f"{path}: made under the protocol {manifest['protocol']!r}")
    if manifest["spark"].split(".")[0] != pyspark.__version__.split(".")[0]:
        raise ArtifactChanged(f"{path}: made under Spark {manifest['spark']}")
    return _forest(json.loads(text)), manifest
