"""Predicates, labels, keys and scores of single rows (survey 2.C, 2.G, 2.J, 2.M)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import hamming


def safe_path(path: Column) -> Column:
    """Relative, without parent references or backslashes."""
    return F.coalesce(~path.startswith("/") & ~path.contains("\\") & ~F.array_contains(F.split(path, "/"), "..") & (path != ""), F.lit(False))


def in_unit_square(points: Column) -> Column:
    """Whether all x, y of an array of points lie in [0, 1] (C11)."""
    return F.forall(points, lambda p: p["x"].between(0, 1) & p["y"].between(0, 1))


def admitted(new: Column, old: Column, status: Column, allowed: list[str]) -> Column:
    """A newer decision overrides the older flag; a missing one is not a refusal."""
    return F.coalesce(new, old).eqNullSafe(F.lit(True)) & F.coalesce(status.isin(allowed), F.lit(False))


def context_labels(setting: Column, description: Column, terms: dict[str, tuple[list[str], str]]) -> Column:
    """Sorted labels whose settings hold the setting or whose pattern the description."""
    hits = [F.when(F.coalesce(setting.isin(s), F.lit(False)) | F.coalesce(description.rlike(p), F.lit(False)), F.lit(k)) for k, (s, p) in terms.items()]
    return F.array_sort(F.array_compact(F.array(*hits)))


def supervision_role(negative: Column, abstained: Column, present: Column) -> Column:
    """negative, abstention, presence, positive, in this precedence; missing is not false."""
    return F.when(negative.eqNullSafe(F.lit(True)), "negative").when(abstained.isNotNull(), "abstention").when(present.eqNullSafe(F.lit(True)), "presence").otherwise("positive")


def class_labels(classes: Column, names: list[str]) -> Column:
    """Distinct sorted names of the class numbers."""
    table = F.array(*[F.lit(n) for n in names])
    return F.array_sort(F.array_distinct(F.transform(classes, lambda c: F.get(table, c))))


def mirrored_distance(a: Column, a_flip: Column, b: Column, b_flip: Column, both: bool = True) -> Column:
    """Least distance over the mirrored variants; without ``both`` flipped never meets flipped."""
    pairs = [hamming(a, b), hamming(a_flip, b), hamming(a, b_flip)] + ([hamming(a_flip, b_flip)] if both else [])
    return F.least(*pairs)


def mean_difference(a: Column, b: Column) -> Column:
    """Mean absolute difference of two equally long arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0), lambda s, v: s + v) / F.size(a)


def split_name(name: Column, aliases: dict[str, str]) -> Column:
    """A split's name by its alias, trimmed and in any case, else as it is in lower case."""
    low = F.lower(F.trim(name))
    out = low
    for k, v in aliases.items():
        out = F.when(low == k, v).otherwise(out)
    return out


def natural_key(name: Column) -> Column:
    """Digits padded to equal width, so that text order is number order."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), 0)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p)), "")


def event_key(domain: str, members: Column) -> Column:
    """A domain-separated digest of the sorted distinct members."""
    return F.sha2(F.concat(F.lit(domain + "\0"), F.to_json(F.array_sort(F.array_distinct(members)))), 256)


def block_id(name: Column, size: int) -> Column:
    """The number in a name divided by the block size, null without one."""
    digits = F.nullif(F.regexp_extract(name, r"(\d+)", 1), F.lit(""))
    return F.floor(digits.cast("long") / size)


def composite(score: Column, small: Column) -> Column:
    """0.70 of the score and 0.30 of the small-object score, a missing one (-1) as 0 (M5)."""
    return 0.70 * score + 0.30 * F.greatest(F.lit(0.0), small)


def disagreement(unsupported: Column, n: Column, misses: Column, extras: Column) -> Column:
    """unsupported / n + half the misses + a quarter of at most four extras."""
    return F.when(n > 0, unsupported / n).otherwise(F.lit(0.0)) + 0.5 * misses + 0.25 * F.least(extras, F.lit(4))


def family(value: Column, record: Column, mirrors: list[tuple[str, str, str]], tokens: list[tuple[str, str]]) -> Column:
    """The family of a source: first mirrors (source, file-name pattern, family), then the first token held, else itself."""
    name = F.element_at(F.split(F.coalesce(record, F.lit("")), r"[/\\]"), -1)
    out = F.lit(None).cast("string")
    for token, kind in reversed(tokens):
        out = F.when(F.contains(F.lower(value), F.lit(token)), F.lit(kind)).otherwise(out)
    for source, pattern, kind in reversed(mirrors):
        out = F.when((value == source) & name.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return F.coalesce(out, value)


def artifact_class(path: Column, consumed: Column, remote: Column, caches: list[str], models: list[str], datasets: list[str]) -> Column:
    """rebuildable_cache, active_local, remote_available, legacy_model, unused_dataset or unknown, in this order."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    cached = F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*[F.lit(c) for c in caches]))
    return F.when(cached, "rebuildable_cache").when(consumed, "active_local").when(remote, "remote_available").when(suffix.isin(models), "legacy_model").when(suffix.isin(datasets), "unused_dataset").otherwise("unknown")


def retry_delay(header: Column, attempt: Column, most: float) -> Column:
    """The larger of the stated seconds and 2**attempt, at most ``most``; an unreadable header counts as none."""
    backoff = F.least(F.pow(F.lit(2.0), attempt), F.lit(most))
    return F.least(F.greatest(F.coalesce(F.trim(header).try_cast("double"), F.lit(0.0)), backoff), F.lit(most))


def training_plan(views: Column, batch: int, accumulate: int, epochs: int, most: int) -> Column:
    """Batches and steps of an epoch, all steps, and whether they keep within ``most``."""
    batches = F.ceil(views / F.lit(batch))
    steps = F.ceil(batches / F.lit(accumulate))
    return F.struct(batches.alias("batches"), steps.alias("steps"), (steps * epochs).alias("all_steps"), (steps * epochs <= most).alias("allowed"))


def message_content(prompt: Column, attachments: Column, tag: str) -> Column:
    """Typed content of a prompt cut at an inline tag: trimmed texts that are not empty, and attachments
    in between; null if tags and attachments differ in number (N28)."""
    parts = F.transform(F.split(prompt, tag), lambda p: F.trim(p))
    pick = F.transform(parts, lambda p, i: F.array(F.struct(F.lit("image").alias("type"), F.get(attachments, i - 1).alias("value")), F.struct(F.lit("text").alias("type"), p.alias("value"))))
    good = F.filter(F.flatten(pick), lambda c: c["value"].isNotNull() & (c["value"] != ""))
    return F.when(F.size(parts) - 1 == F.size(attachments), good)


def leaves(schema: T.DataType, suffix: str, at: str = "") -> list[str]:
    """Dotted names of all leaves of a schema that end in ``suffix``, at any depth (C20)."""
    if isinstance(schema, T.ArrayType):
        return leaves(schema.elementType, suffix, at)
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in leaves(f.dataType, suffix, f"{at}.{f.name}" if at else f.name)]
    return [at] if at.rpartition(".")[2].endswith(suffix) else []


def harvested(schema: T.StructType, suffix: str) -> Column:
    """The sorted distinct values of all leaves that end in ``suffix``, those in arrays included (C20)."""

    def values(kind: T.DataType, c: Column, name: str) -> list[Column]:
        if not leaves(kind, suffix, name):
            return []
        if isinstance(kind, T.StructType):
            return [v for f in kind.fields for v in values(f.dataType, c[f.name], f.name)]
        if isinstance(kind, T.ArrayType):
            return [F.flatten(F.transform(F.coalesce(c, F.array().cast(kind)), lambda x: F.concat(*values(kind.elementType, x, name))))]
        return [F.array(c.cast("string"))]

    found = [v for f in schema.fields for v in values(f.dataType, F.col(f.name), f.name)]
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(*found)))) if found else F.array().cast("array<string>")
