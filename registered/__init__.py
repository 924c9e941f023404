"""The queries the driver runs, each with the SQL it is compared with."""
