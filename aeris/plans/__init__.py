"""Jobs (write the medallion zones) and the catalog of registered queries."""
