"""Writers: partitioned tables with dynamic overwrite, site exports, ML export,
namespace creation and an output report (``writers``)."""
