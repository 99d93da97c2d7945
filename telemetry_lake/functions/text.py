"""Text columns: keys, tokens, URIs and join renderings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def key_part(key: Column, index: int, separator: str = r"\.") -> Column:
    """Part ``index`` of a separated key, null when the key is shorter."""
    return F.get(F.split(key, separator), F.lit(index))


def tokenize(text: Column, separator: str = r"\W+") -> Column:
    """Lower-case words of ``text``.

    A text that starts with a separator yields a leading empty word; trailing
    empty words are dropped, and text made of separators only has no word. Text
    without any separator, the empty text included, is one word.
    """
    parts = F.filter(F.split(F.lower(text), separator), lambda word, i: (word != "") | (i == 0))
    return F.when(separators_only(text, separator), F.array().cast("array<string>")).otherwise(parts)


def separators_only(text: Column, separator: str = r"\W+") -> Column:
    return text.rlike(f"^(?:{separator})$")


def path_segment(path: Column, index: int) -> Column:
    """Segment ``index`` of a slash-separated path (0 is the part before the first slash)."""
    return key_part(path, index, "/")


# scheme://[user@]host[:port]/container[/path] and scheme://container@host[:port][/path];
# query and fragment stay where they are.
_WEB = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#@]+)/([^/?#]+)"
_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]+)@([^/?#@]+)"


def uri_to_store(uri: Column, scheme: str = "wasbs") -> Column:
    """``https://host/container/path`` to ``scheme://container@host/path``; null without a container."""
    return F.when(uri.rlike(_WEB), F.regexp_replace(uri, _WEB, f"{scheme}://$2@$1"))


def uri_from_store(uri: Column, scheme: str = "https") -> Column:
    """``store://container@host/path`` to ``scheme://host/container/path``; null without a container."""
    return F.when(uri.rlike(_STORE), F.regexp_replace(uri, _STORE, f"{scheme}://$2/$1"))


def text_or_default(value: Column, data_type: T.DataType) -> Column:
    """Text of a value that may be missing: absent numbers read ``0``, absent text ``null``."""
    missing = "null" if isinstance(data_type, T.StringType) else "0"
    return F.coalesce(value.cast("string"), F.lit(missing))


def render_pair(first: Column, first_type: T.DataType, second: Column, second_type: T.DataType) -> Column:
    """``first/second`` with the defaults of :func:`text_or_default`."""
    return F.concat_ws("/", text_or_default(first, first_type), text_or_default(second, second_type))
