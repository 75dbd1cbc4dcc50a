"""Token ids as flat binary files with 64-bit offsets, in document order.

Documents are sorted by range over tasks. Each task writes its ids, offsets and document ids as
flat files named by the attempt and reports one manifest row, so a repeated attempt leaves files
that no manifest names. The place of a file in the whole sequence is the prefix sum of the token
counts before it. Readers map the files into memory where the store is a local or mounted one and
read ranges of them otherwise.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import chunks, text_or_empty
from barweave.llm.tokens import encoder
from barweave.storage import new_path

#: Stands for a null document id in the files.
NO_ID = -(2**63)
_MANIFEST = "part long, ids string, offsets string, docs string, n_docs long, n_tokens long, width int"


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int | None = None,
) -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id`` and write the files.

    Returns the manifest, a stored table in ``folder``: part, base (ids before the file), file
    names, counts and the bytes of an id. Ids take two bytes if the vocabulary allows, else four.
    Documents are in ascending id order, null ids first; rows that share an id follow one another.
    An empty table gives an empty manifest.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        width = 2 if max(code.size - 1, end_id) < 2**16 else 4
        context, counts, files = TaskContext.get(), [], None
        store, root = _store(folder)
        names = [
            f"part-{context.partitionId():06d}-{context.taskAttemptId()}.{kind}"
            for kind in ("ids", "offsets", "docs")
        ]
        total = 0
        for piece in chunks(batches, "_text"):
            if files is None:
                store.create_dir(root, recursive=True)
                files = [store.open_output_stream(f"{root}/{n}") for n in names]
                files[1].write(np.zeros(1, "<i8").tobytes())
            encoded = code.encode(piece.column("_text").to_pylist())
            lengths = np.array([len(e) + 1 for e in encoded], np.int64)
            for e in encoded:
                files[0].write(np.append(e, np.uint32(end_id)).astype(f"<u{width}").tobytes())
            ends = total + np.cumsum(lengths)
            files[1].write(ends.astype("<i8").tobytes())
            total = int(ends[-1])
            known = piece.column("_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            files[2].write(known.astype("<i8").tobytes())
            counts.append(len(encoded))
        if files is not None:
            for f in files:
                f.close()
            row = [[context.partitionId()], *[[n] for n in names], [sum(counts)], [total], [width]]
            kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.int32()]
            arrays = [pa.array(v, k) for v, k in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _MANIFEST.split(", ")])

    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"), text_or_empty(text_col).alias("_text")
    )
    done = rows.repartitionByRange(n, "_id").sortWithinPartitions("_id", "_text")
    done.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with ``base``, the prefix sum of the counts; it has one row for each file."""
    stored = spark.read.parquet(f"{folder}/manifest")
    rows = sorted(stored.collect(), key=lambda r: r["part"])
    bases = itertools.accumulate((r["n_tokens"] for r in rows), initial=0)
    schema = T.StructType([*stored.schema.fields, T.StructField("base", T.LongType())])
    return spark.createDataFrame([(*r, b) for r, b in zip(rows, bases)], schema)


def _open(store, root: str, name: str, kind: str) -> np.ndarray:
    from pyarrow import fs

    path = f"{root}/{name}"
    if isinstance(store, fs.LocalFileSystem):
        size = store.get_file_info(path).size
        return np.memmap(path, kind, "r") if size else np.zeros(0, kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    The crc is of the ids as little-endian unsigned 32-bit integers. A file is read by one task.
    """
    out = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        + ([("ids", pa.list_(pa.int64()))] if with_ids else [])
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for file in itertools.chain.from_iterable(b.to_pylist() for b in batches):
            ids = _open(store, root, file["ids"], f"<u{file['width']}")
            ends = _open(store, root, file["offsets"], "<i8")
            docs = _open(store, root, file["docs"], "<i8")
            for at in range(0, len(docs), 5000):
                d = np.array(docs[at : at + 5000])
                o = np.array(ends[at : at + len(d) + 1])
                own = [ids[a:b].astype("<u4") for a, b in itertools.pairwise(o.tolist())]
                columns = [
                    pa.array(d, mask=d == NO_ID),
                    pa.array(o[:-1] + file["base"]),
                    pa.array(np.diff(o)),
                    pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long"
    spread = manifest.repartition(max(1, manifest.count()), "part")
    return spread.mapInArrow(read, kinds + (", ids array<long>" if with_ids else ""))


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files to a new place in the shared folder and read them back."""
    folder = new_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), folder)
