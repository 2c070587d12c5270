"""Hash keys for urls and contents."""

from pyspark.sql import Column, functions as F


def url_key(url: Column) -> Column:
    return F.left(F.sha2(url, 256), F.lit(32))


def content_key(text: Column) -> Column:
    return F.md5(text)


def extraction_key(text: Column) -> Column:
    """Memo key of an extraction: the hash of the whole content."""
    return F.md5(text)


def external_key(name: Column) -> Column:
    """Cache key of outside data: the hash of the whole name, case ignored."""
    return F.concat(F.lit("ext2:"), F.sha2(F.lower(name), 256))
