"""Archives of any size: members are streamed to files of their own, which Spark reads in parallel."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def unpack(spark: SparkSession, path: str, target: str, suffix: str = "") -> list[str]:
    """Copy the members of a zip archive whose names end in ``suffix`` to the folder ``target``; returns their paths.

    Both paths may be in any store that Spark reads. Bytes are copied by the
    JVM, buffer by buffer, so neither the archive nor a member has to fit in
    memory. Folders inside the archive become part of a flat file name, so no
    member can leave ``target``. Existing files are replaced.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, files = _files(spark, path)
    archive, out = jvm.java.util.zip.ZipInputStream(files.open(source)), []
    try:
        while (entry := archive.getNextEntry()) is not None:
            if entry.isDirectory() or not entry.getName().endswith(suffix):
                continue
            name = entry.getName().replace("\\", "/").strip("/").replace("/", "__")
            member, there = _files(spark, f"{target}/{name}")
            stream = there.create(member, True)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(archive, stream, conf, False)
            stream.close()
            out.append(f"{target}/{name}")
    finally:
        archive.close()
    return sorted(out)


def pack(spark: SparkSession, members: dict[str, str], path: str) -> None:
    """Write files (name in the archive to path) into one zip archive, streamed by the JVM."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, files = _files(spark, path)
    archive = jvm.java.util.zip.ZipOutputStream(files.create(target, True))
    try:
        for name, source in sorted(members.items()):
            archive.putNextEntry(jvm.java.util.zip.ZipEntry(name))
            where, there = _files(spark, source)
            stream = there.open(where)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, archive, conf, False)
            stream.close()
            archive.closeEntry()
    finally:
        archive.close()


def parts_of(spark: SparkSession, folder: str) -> list[str]:
    """The data files that a writer left in ``folder``."""
    where, files = _files(spark, folder)
    names = [str(s.getPath().toString()) for s in files.listStatus(where)]
    return sorted(n for n in names if n.rsplit("/", 1)[-1].startswith("part-"))


def remove(spark: SparkSession, path: str) -> None:
    where, files = _files(spark, path)
    files.delete(where, True)
