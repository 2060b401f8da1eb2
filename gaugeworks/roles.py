"""Column roles: which column plays which part in a sensor table."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SeriesRoles:
    """Names of the columns an operator works on.

    ``seq`` breaks ties between readings with the same time.  ``machine`` may
    be empty, in which case the table is one long series.
    """

    time: str = "timestamp"
    seq: tuple[str, ...] = ()
    machine: tuple[str, ...] = ()
    analog: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    label: str = "fault_label"
    failure_id: str = "failure_id"

    @property
    def order(self) -> tuple[str, ...]:
        """Total order of the readings inside one machine."""
        return (self.time, *self.seq)

    @property
    def sensors(self) -> tuple[str, ...]:
        return (*self.analog, *self.flags)

    def with_(self, **changes) -> SeriesRoles:
        return replace(self, **changes)


# The channels of the air-compressor record, as the raw files name them.
COMPRESSOR_ANALOG = (
    "TP2",
    "TP3",
    "H1",
    "DV_pressure",
    "Reservoirs",
    "Oil_temperature",
    "Motor_current",
    "Caudal_impulses",
)
COMPRESSOR_FLAGS = (
    "COMP",
    "DV_eletric",
    "Towers",
    "MPG",
    "LPS",
    "Pressure_switch",
    "Oil_level",
)

# Names under which CSV writers leave the row index.
INDEX_ALIASES = ("_c0", "Unnamed: 0")

COMPRESSOR = SeriesRoles(
    time="timestamp",
    seq=("seq",),
    machine=("machine_id",),
    analog=COMPRESSOR_ANALOG,
    flags=COMPRESSOR_FLAGS,
)
