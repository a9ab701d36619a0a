"""Declarative description of a source and target pair, and the registry of pairs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Copy:
    """Pass a column on, renamed and cut to ``max_chars`` code points if given."""

    source: str
    output: str
    max_chars: int | None = None


@dataclass(frozen=True)
class Merge:
    """Join several text columns into one; a ``required`` result must not be blank."""

    sources: tuple[str, ...]
    output: str
    separator: str = " "
    max_chars: int | None = None
    required: bool = False


@dataclass(frozen=True)
class TransformSpec:
    source: str
    target: str
    key: str
    key_output: str
    namespace: uuid.UUID
    fields: tuple[Copy | Merge, ...]
    description: str = ""
    # Most characters each target column may hold, and target columns that must have a value; a
    # load puts rows that break either into quarantine.
    limits: dict[str, int] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    # Extra step before the mapping, for what the fields cannot say.
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def target_columns(self) -> list[str]:
        return [self.key_output, *[f.output for f in self.fields]]

    def source_columns(self) -> list[str]:
        names = [self.key]
        for one in self.fields:
            names += one.sources if isinstance(one, Merge) else [one.source]
        return list(dict.fromkeys(names))


# Fixed value: the namespace that makes a patient's key the same in every run.
PATIENT_NAMESPACE = uuid.UUID("a1b2c3d4-e5f6-7890-abcd-ef1234567890")

# The names of both tables' columns, the cuts and the limits of the target.
PATIENTS = TransformSpec(
    source="pasien",
    target="pasien",
    key="id_pasien",
    key_output="pasien_uuid",
    namespace=PATIENT_NAMESPACE,
    description="integer key to UUID key, first and last name merged",
    fields=(
        Merge(("nama_depan", "nama_belakang"), "nama_lengkap", max_chars=100, required=True),
        Copy("tanggal_lahir", "tanggal_lahir"),
        Copy("jenis_kelamin", "gender"),
        Copy("email", "email", max_chars=100),
        Copy("no_telepon", "telepon"),
        Copy("alamat", "alamat_lengkap"),
        Copy("kota", "kota"),
        Copy("provinsi", "provinsi"),
        Copy("kode_pos", "kode_pos"),
        Copy("golongan_darah", "golongan_darah"),
        Copy("kontak_darurat", "nama_kontak_darurat"),
        Copy("no_kontak_darurat", "telepon_kontak_darurat"),
        Copy("tanggal_registrasi", "tanggal_registrasi"),
    ),
    limits={
        "nama_lengkap": 100,
        "gender": 10,
        "email": 100,
        "telepon": 20,
        "alamat_lengkap": 255,
        "kota": 50,
        "provinsi": 50,
        "kode_pos": 10,
        "golongan_darah": 5,
        "nama_kontak_darurat": 100,
        "telepon_kontak_darurat": 20,
    },
    not_null=("pasien_uuid", "nama_lengkap"),
)

_REGISTRY: dict[str, TransformSpec] = {}


def register(spec: TransformSpec) -> TransformSpec:
    _REGISTRY[spec.source] = spec
    return spec


def lookup(source: str, target: str | None = None) -> TransformSpec:
    """The spec of a pair. Both names are checked when both are given."""
    spec = _REGISTRY.get(source)
    if spec is None or target not in (None, spec.target):
        pair = source if target is None else f"{source} -> {target}"
        raise LookupError(f"no transformation is registered for {pair}")
    return spec


register(PATIENTS)
