"""What the pipeline takes from outside instead of fixing it in code."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """``partition_date``: the registry delivery that counts. ``publication_date``: of the ranking lists.

    The defaults are fixed values: dates, depth and labels that results have to show.
    """

    partition_date: str = "2026-01-11"
    publication_date: str = "2025-09-16"
    ranking_title: str = "Valor 1000 2025"
    walk_depth: int = 8
    list_year: int = 2025
    registry_year: int = 2026
    filing_label: str = "fre_cia_aberta_posicao_acionaria_2026"
    #: razao_social -> cnpj for names that no source resolves
    exceptions: tuple[tuple[str, str], ...] = ()
