"""Tokenizer state as versioned Parquet tables instead of a pickle.

A save writes a version folder with ``vocab`` (token, id; last write wins),
``inverse_vocab`` (id, token; every id), ``merges`` (rank, l, r, c, id) and,
last, a ``manifest`` (JSON: kind, mode, rows of each table, a digest of their
contents), whose commit marker appears when all is written.  Readers take the
newest version with a manifest, so a save that stops half way leaves the
version before it in place, and nothing is ever overwritten.  Loading reads
tables, so it cannot run code; a store that is missing, short or altered
raises (upstream printed a message and returned None).

:func:`fitted` keeps tokenizers by what they were fitted on: the identity of
the input files and the parameters name the store.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tokenmill.operators.bpe import BPETokenizer
from tokenmill.operators.tokenizer import CharacterTokenizer, Tokenizer
from tokenmill.plans.rounds import input_fingerprint
from tokenmill.session import ensure_checkpoint_dir

TABLES = ("vocab", "inverse_vocab", "merges")


class TokenizerStoreError(RuntimeError):
    pass


def _digest(vocab, inverse, merges) -> str:
    rows = [sorted(map(list, vocab)), sorted(map(list, inverse)), sorted(map(list, merges))]
    return hashlib.sha256(json.dumps(rows).encode()).hexdigest()


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the whole versions, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    base = hadoop(path.rstrip("/"))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(base))
    return [f"{path.rstrip('/')}/{n}" for n in names
            if n.startswith("version-") and fs.exists(hadoop(f"{path.rstrip('/')}/{n}/manifest/_SUCCESS"))]


def save_tokenizer(spark: SparkSession, tok: Tokenizer, path: str) -> str:
    """Write a new version; returns its folder."""
    known = versions(spark, path)
    number = int(known[-1].rsplit("/version-", 1)[1].split("-")[0]) + 1 if known else 1
    at = f"{path.rstrip('/')}/version-{number:06d}-{uuid.uuid4().hex[:8]}"
    merges = list(getattr(tok, "merges", []))
    tok.vocab_df(spark).write.parquet(f"{at}/vocab")
    tok.inverse_vocab_df(spark).write.parquet(f"{at}/inverse_vocab")
    spark.createDataFrame(merges, "rank int, l string, r string, c long, id int").write.parquet(f"{at}/merges")
    manifest = {"kind": "bpe" if isinstance(tok, BPETokenizer) else "char", "num_merges": int(getattr(tok, "num_merges", 0)),
                "mode": getattr(tok, "mode", "reference"),
                "rows": {"vocab": len(tok.stoi), "inverse_vocab": len(tok.itos), "merges": len(merges)},
                "digest": _digest(tok.stoi.items(), tok.itos.items(), merges)}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{at}/manifest")
    return at


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    """The newest whole version below ``path``."""
    found = versions(spark, path)
    if not found:
        raise TokenizerStoreError(f"no whole tokenizer version at {path!r}")
    at = found[-1]
    try:
        manifest = json.loads("".join(r["value"] for r in spark.read.text(f"{at}/manifest").collect()))
        rows = {name: [tuple(r) for r in spark.read.parquet(f"{at}/{name}").collect()] for name in TABLES}
        expected, digest = manifest["rows"], manifest["digest"]
    except Exception as exc:  # noqa: BLE001 - any read failure means a bad store
        raise TokenizerStoreError(f"cannot read tokenizer store at {at!r}: {exc}") from exc
    short = {n: len(rows[n]) for n in TABLES if len(rows[n]) != expected[n]}
    if short:
        raise TokenizerStoreError(f"tokenizer store at {at!r} has {short} rows instead of {expected}")
    if _digest(*(rows[n] for n in TABLES)) != digest:
        raise TokenizerStoreError(f"tokenizer store at {at!r} is altered")
    tok: Tokenizer = (BPETokenizer(manifest["num_merges"], mode=manifest["mode"]) if manifest["kind"] == "bpe"
                      else CharacterTokenizer())
    tok.stoi = dict(rows["vocab"])
    tok.itos = dict(rows["inverse_vocab"])
    if isinstance(tok, BPETokenizer):
        tok.merges = sorted(rows["merges"])
    return tok


def fitted(df: DataFrame, num_merges: int, col: str = "text", mode: str = "reference", folder: str | None = None) -> tuple[BPETokenizer, str]:
    """(tokenizer, its store): loaded if one was fitted on the same files with
    the same parameters, else fitted (resumably) and stored."""
    spark = df.sparkSession
    base = (folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokenizers").rstrip("/")
    path = f"{base}/{input_fingerprint(df, col, num_merges, mode)}"
    if not versions(spark, path):
        save_tokenizer(spark, BPETokenizer(num_merges, mode=mode).fit(df, col, state=f"{path}/rounds"), path)
    return load_tokenizer(spark, path), path


def vocab_table(spark: SparkSession, path: str) -> DataFrame:
    """(token, id) of the newest whole version, as stored."""
    found = versions(spark, path)
    if not found:
        raise TokenizerStoreError(f"no whole tokenizer version at {path!r}")
    return spark.read.parquet(f"{found[-1]}/vocab")
