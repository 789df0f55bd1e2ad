"""Operators Spark has no single built-in for, composed from DataFrame operations.

* ``ordered``    -- running sums, row positions, LAG and exact percentiles that
                    split a hot key over many tasks (range slices + carry);
* ``aggregates`` -- RANK() = 1, latest row per key, window aggregates and
                    pair statistics expressed as partial aggregates + joins;
* ``joins``      -- IN / NOT IN / EXISTS, anti joins and bounded range lookups.
"""
