"""Every query of the engine by name, with SQL where SQL can express it."""

from __future__ import annotations

from . import activity, clusters, editing, extras, geometry, network, neurons, past, readers, searching, shapes, whole

QUERIES = {**network.QUERIES, **searching.QUERIES, **activity.QUERIES, **shapes.QUERIES, **neurons.QUERIES, **readers.QUERIES, **editing.QUERIES, **extras.QUERIES, **clusters.QUERIES, **geometry.QUERIES, **past.QUERIES, **whole.QUERIES}
SQL = {**network.SQL, **searching.SQL, **activity.SQL, **shapes.SQL, **neurons.SQL, **readers.SQL, **editing.SQL, **extras.SQL, **clusters.SQL, **geometry.SQL, **past.SQL, **whole.SQL}
