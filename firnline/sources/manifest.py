"""Which files are new, which have gone, and forgetting a file so it is read again.

The stored manifest is partitioned by folder. Beside it lies one row per folder with the number of its files and the time of its
newest one at the last look; only folders for which that has changed are compared with the manifest.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.sizes import settled

MANIFEST = "path string, folder string"
FOLDERS = "folder string, files long, newest timestamp"
# fixed values: folders the file search skips
EXCLUDED_DIRS = ("Processed", "1998_to_2014")


def list_files(spark, path, glob="*.json", times=False):
    """All file paths under ``path``, with the time each was written as ``modified`` if asked for; only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", *([F.col("modificationTime").alias("modified")] if times else []))


def folder_of(path="path"):
    """The folder a path lies in."""
    return F.regexp_replace(path, "/[^/]*$", "")


def folder_state(files):
    """(folder, files, newest) of a listing with times."""
    return files.groupBy(folder_of().alias("folder")).agg(F.count("*").alias("files"), F.max("modified").alias("newest"))


def changed_folders(state, stored):
    """Folders whose state is not the stored one; ``stored`` may be None."""
    if stored is None:
        return state.select("folder")
    old = stored.select("folder", F.col("files").alias("_files"), F.col("newest").alias("_newest"))
    same = F.col("files").eqNullSafe(F.col("_files")) & F.col("newest").eqNullSafe(F.col("_newest"))
    return state.join(old, "folder", "left").where(~same).select("folder")


def new_files(files, manifest, changed):
    """Paths in changed folders (settled) that the manifest (path, folder) does not have; of other folders nothing is read."""
    own = files.withColumn("folder", folder_of()).join(changed, "folder", "left_semi")
    # the comparison is true of all; Spark skips partitions at run time only where the other side is filtered
    seen = manifest.join(changed.where("folder > ''"), "folder", "left_semi").select("folder", "path")
    return own.join(seen, ["folder", "path"], "left_anti").select("path")


def _stored(spark, path, schema):
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def unseen_files(spark, files, path):
    """New paths (settled) of a listing with times, and the folder states to note when they are taken in (note_folders)."""
    state = settled(folder_state(files), "folders")
    changed = settled(changed_folders(state, _stored(spark, f"{path}-folders", FOLDERS)), "changed")
    manifest = _stored(spark, path, MANIFEST)
    if manifest is None:
        manifest = spark.createDataFrame([], MANIFEST)
    return settled(new_files(files, manifest, changed), "unseen"), state


def note_files(paths, path):
    """Add paths to the stored manifest."""
    paths.select("path", folder_of().alias("folder")).repartition("folder").write.mode("append").partitionBy("folder").parquet(path)


def note_folders(state, path):
    """Replace the stored folder states; state is settled, so it does not come from what is replaced."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}-folders")


def forget_stored(spark, path, part):
    """Take the paths that contain ``part`` out of the stored manifest and forget the state of their folders."""
    manifest, state = _stored(spark, path, MANIFEST), _stored(spark, f"{path}-folders", FOLDERS)
    if manifest is None:
        return
    hit = settled(manifest.where(F.col("path").contains(part)).select("folder").distinct(), "hit")
    # a folder left without paths keeps one empty row, for a partition without rows would not be replaced
    rest = forget_files(manifest, part).join(hit, "folder", "left_semi").unionByName(hit.withColumn("path", F.lit("")))
    settled(rest, "rest").repartition("folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(path)
    if state is not None:
        note_folders(settled(state.join(hit, "folder", "left_anti"), "folders"), path)


def station_files(listing, station=None):
    """JSON files outside the excluded folders, of one station if given."""
    out = listing.where(F.col("path").endswith(".json"))
    for d in EXCLUDED_DIRS:
        out = out.where(~F.col("path").contains(f"/{d}/"))
    return out.where(F.element_at(F.split("path", "/"), -1).contains(station)) if station else out


def file_changes(listing, manifest):
    """Added and removed paths, each with its state."""
    added = listing.join(manifest, "path", "left_anti").select("path", F.lit("added").alias("state"))
    removed = manifest.join(listing, "path", "left_anti").select("path", F.lit("removed").alias("state"))
    return added.unionByName(removed)


def next_manifest(listing, manifest):
    """Everything on disk plus everything ever seen."""
    return listing.select("path").unionByName(manifest.select("path")).distinct()


def forget_files(manifest, part):
    """Manifest without the paths that contain ``part``."""
    return manifest.where(~F.col("path").contains(part))
