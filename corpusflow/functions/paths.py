"""Paths, names and ids in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Audio extensions.
AUDIO_EXTENSIONS = ("mp3", "wav", "flac", "ogg", "opus")

# Patterns of ids in names, links and pages.
CHUNK_RANGE = r"^(\d+(?:\.\d+)?)_(\d+(?:\.\d+)?)(?:_|$)"
CHUNK_IDS = r"^(\d+(?:\.\d+)?)_(\d+(?:\.\d+)?)_([^_]+)_(.+)$"
CHUNK_NAME = r"^\d+\.\d+_\d+\.\d+_"
ALBUM_LINK = r"/album/(\d+)"
EPISODE_LINK = r"(?:album|playlist)/\d+/(\d+)"
PLAYLIST_LINKS = (r"/users/([^/]+)/playlists/(\d+)", r"/playlists/([^/]+)/(\d+)")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """The last suffix without its dot, in lower case."""
    return F.lower(F.regexp_extract(file_name(path), r"(?<=.)\.([^.]*)$", 1))


def parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def is_audio(path: Column) -> Column:
    return suffix(path).isin(*AUDIO_EXTENSIONS)


def normalise(path: Column, root: str) -> Column:
    """Stripped; blank is empty; relative paths stand below root."""
    p = strip(F.coalesce(path, F.lit("")))
    return F.when((p == "") | p.startswith("/"), p).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace(p, r"^(\./)+", "")))


def sidecar(path: Column, kind: str) -> Column:
    """The text file of a kind beside a clip."""
    return F.concat(parent(path), F.lit("/"), stem(path), F.lit(f"_{kind}.txt"))


def replace_in_stem(path: Column, old: str, new: str) -> Column:
    """All occurrences in the stem, none elsewhere."""
    return F.concat(F.regexp_extract(path, "^(.*/)?[^/]*$", 1), F.replace(stem(path), F.lit(old), F.lit(new)), F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]*)$", 1))


def shard_key(path: Column) -> Column:
    return F.replace(stem(path), F.lit("."), F.lit("_"))


def stage_dir(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def is_chunk_name(path: Column) -> Column:
    return file_name(path).rlike(CHUNK_NAME)


def album_id(url: Column) -> Column:
    return _found(url, ALBUM_LINK, 1)


def episode_id(url: Column) -> Column:
    return _found(url, EPISODE_LINK, 1)


def playlist_ref(url: Column) -> Column:
    """struct(owner, kind) of a playlist link, null when it is none."""
    owner = F.coalesce(*[_found(url, p, 1) for p in PLAYLIST_LINKS])
    kind = F.coalesce(*[_found(url, p, 2) for p in PLAYLIST_LINKS])
    return F.when(owner.isNotNull(), F.struct(owner.alias("owner"), kind.alias("kind")))


def is_playlist(url: Column) -> Column:
    return url.contains("/playlists/")


def cover_url(template: Column, size: str = "1000x1000") -> Column:
    return F.concat(F.lit("https://"), F.replace(template, F.lit("%%"), F.lit(size)))


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def identity(path: Column, duration: Column) -> Column:
    """struct(start, end, playlist_id, podcast_id) of a clip from its path below the root.

    Three parts or more name both folders; else the ids in the stem count; else the folder and the stem. Ids are
    text. A range that is missing or empty is the whole clip.
    """
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    n, name = F.size(parts), stem(path)
    playlist, podcast = _found(name, CHUNK_IDS, 3), _found(name, CHUNK_IDS, 4)
    start, end = _found(name, CHUNK_RANGE, 1).cast("double"), _found(name, CHUNK_RANGE, 2).cast("double")
    valid = F.coalesce(end > start, F.lit(False))
    return F.struct(
        F.bround(F.when(valid, start).otherwise(0.0), 2).alias("start"),
        F.bround(F.when(valid, end).otherwise(duration), 2).alias("end"),
        F.when(n >= 3, F.get(parts, n - 3)).when(playlist.isNotNull(), playlist).when(n >= 2, F.get(parts, n - 2)).otherwise("").alias("playlist_id"),
        F.when(n >= 3, F.get(parts, n - 2)).when(playlist.isNotNull(), podcast).otherwise(name).alias("podcast_id"),
    )


def chunk_name(start: Column, end: Column, album: Column, episode: Column, ext: Column) -> Column:
    return F.format_string("%.2f_%.2f_%s_%s.%s", start, end, album, episode, ext)


def container(ext: Column, wanted: str = "auto") -> Column:
    """The container of a chunk: auto keeps a known extension, anything unknown is flac."""
    own = F.lower(F.regexp_replace(ext, r"^\.", ""))
    pick = own if wanted == "auto" else F.lit(wanted.lower().lstrip("."))
    return F.when(pick.isin(*AUDIO_EXTENSIONS), pick).otherwise("flac")
