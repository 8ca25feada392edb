import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def label(dep):
    return dep["table_name"] or f"{dep['node_type']}:{dep['node_name']}"


def by_name(nodes):
    """name -> (type, description, url, upstream labels, downstream labels or None)"""
    out = {}
    for r in nodes.collect():
        down = r.lineage.downstream_dependencies
        out.setdefault(r.name, []).append(
            (
                r.node_type,
                r.attributes.description,
                r.attributes.url,
                [label(d) for d in r.lineage.upstream_dependencies],
                None if down is None else [label(d) for d in down],
            )
        )
    return out
