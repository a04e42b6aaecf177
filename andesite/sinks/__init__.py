"""Everything that runs a job: tables, snapshots, keyed upserts and the serving database."""
