"""Writers: datasets, reports, manifests, archives, pages."""
