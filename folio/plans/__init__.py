from folio.plans import catalog, checks, rules, stories  # noqa: F401  (all register their queries in the catalog)
