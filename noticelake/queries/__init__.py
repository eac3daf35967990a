"""Jobs of the library run over the given tables."""


def modules():
    from noticelake.queries import flows, operations, pages, quality, reports, serving

    return (serving, quality, operations, pages, flows, reports)
