"""Plans: the reference's end-to-end jobs as compositions, and the driver queries."""
