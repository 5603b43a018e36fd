"""Writers: the request table, extract pulls, dead letters and exports."""
