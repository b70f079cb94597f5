"""Which provider, model, key and address a model call uses: the first that is set in a chain, over a map of settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ProviderKind:
    """A provider's name, the settings that may hold its key (in order), its address, its default model, whether it takes batches."""

    name: str
    keys: tuple[str, ...]
    address: str
    model: str
    batch: bool = False


def first_set(settings: Column, *names: Column | str) -> Column:
    """The first of the settings that isn't blank, trimmed; null if none is."""
    key = lambda n: F.lit(n) if isinstance(n, str) else n
    return F.coalesce(*(F.nullif(F.trim(F.try_element_at(settings, key(n))), F.lit("")) for n in names))


def provider(settings: Column, default: str, name: str = "VLM_API_PROVIDER") -> Column:
    return F.coalesce(F.lower(first_set(settings, name)), F.lit(default))


def _of(kinds: tuple[ProviderKind, ...], chosen: Column, value, other) -> Column:
    out = None
    for k in kinds:
        out = F.when(chosen == k.name, value(k)) if out is None else out.when(chosen == k.name, value(k))
    return out.otherwise(other)


def model(settings: Column, kinds: tuple[ProviderKind, ...], default: str, task: Column | str, fallback: str, prefix: str = "VLM") -> Column:
    """The task's own model, then the general ones, then the provider's default, then the fallback."""
    own = F.concat(F.lit(f"{prefix}_"), F.upper(F.trim(F.coalesce(F.lit(task), F.lit("")))), F.lit("_MODEL"))
    return F.coalesce(first_set(settings, own, f"{prefix}_MODEL", f"{prefix}_DEFAULT_MODEL"), _of(kinds, provider(settings, default), lambda k: F.lit(k.model), F.lit(fallback)))


def key(settings: Column, kinds: tuple[ProviderKind, ...], default: str, general: str = "VLM_API_KEY") -> Column:
    """The provider's own key, then the general one; empty if none is set. An unknown provider has the default one's."""
    of = lambda k: F.coalesce(first_set(settings, *k.keys, general), F.lit(""))
    return _of(kinds, provider(settings, default), of, of(next(k for k in kinds if k.name == default)))


def address(settings: Column, kinds: tuple[ProviderKind, ...], default: str) -> Column:
    return _of(kinds, provider(settings, default), lambda k: F.lit(k.address), F.lit(next(k for k in kinds if k.name == default).address))


def takes_batches(settings: Column, kinds: tuple[ProviderKind, ...], default: str) -> Column:
    return _of(kinds, provider(settings, default), lambda k: F.lit(k.batch), F.lit(False))
